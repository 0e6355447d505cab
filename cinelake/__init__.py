"""Spark-native analytics over a star schema of viewing, payment and subscription facts."""

__version__ = "0.1.0"

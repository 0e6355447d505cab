"""Operators of a training-data pipeline over text documents.

One module per operator. Each has its own interface, and a query that applies it to
whole tables with production parameters (``QUERIES``, ``ORACLES`` in ``queries``).
"""

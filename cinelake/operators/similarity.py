"""The four similarities: users raw and mean-centred, contents by behaviour and by text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.operators import pairwise
from cinelake.operators.matrix import Matrix, centred
from cinelake.session import materialize


def raw_user_units(matrix: Matrix) -> DataFrame:
    return pairwise.unit_rows(matrix.seen, "Customer_Key", "Content_Key", "Minutes")


def centred_user_units(matrix: Matrix) -> DataFrame:
    return pairwise.unit_rows(centred(matrix), "Customer_Key", "Content_Key", "Value")


def item_pairs(matrix: Matrix) -> DataFrame:
    """Adjusted cosine between contents, as (a, b, similarity) with a < b, zeros left out."""
    dots = pairwise.gram(
        centred(matrix), "Content_Key", "Customer_Key", "Value", matrix.items, matrix.cell_count
    )
    return pairwise.cosine_pairs(materialize(dots, "item-dots"))


def text_pairs(weights: DataFrame, rows: int, cell_count: int) -> DataFrame:
    """Cosine between texts out of their unit-length term weights (row, feature, value)."""
    dots = pairwise.gram(weights, "row", "feature", "value", rows, cell_count)
    return pairwise.cosine_pairs(materialize(dots, "text-dots"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair in both directions, as (item, other, similarity)."""
    return pairs.select(F.col("a").alias("item"), F.col("b").alias("other"), "similarity").unionByName(
        pairs.select(F.col("b").alias("item"), F.col("a").alias("other"), "similarity")
    )

"""Viewing events as a sparse user by content matrix in long form."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinelake.functions.scalars import clip, to_key, to_number
from cinelake.session import materialize
from cinelake.sources.readers import resolve_columns
from cinelake.sources.schemas import EVENT_ALIASES

# Decimals kept in derived measures, so that ranks do not hang on the order of float sums.
DIGITS = 9

WIDE_COLUMNS = 1000


def normalize_events(events: DataFrame) -> DataFrame:
    """Customer, content and minutes under fixed names and types.

    Rows with an unreadable key or measure are dropped, negative minutes become 0.
    """
    found = resolve_columns(
        events, {c: EVENT_ALIASES[c] for c in ("Customer_Key", "Content_Key", "Minutes_Watched")}
    )
    types = {f.name: f.dataType for f in found.schema.fields}
    return (
        found.select(
            to_key(F.col("Customer_Key"), types["Customer_Key"]).alias("Customer_Key"),
            to_key(F.col("Content_Key"), types["Content_Key"]).alias("Content_Key"),
            to_number(F.col("Minutes_Watched")).alias("Minutes_Watched"),
        )
        .na.drop()
        .withColumn("Minutes_Watched", clip(F.col("Minutes_Watched"), low=0.0))
    )


@dataclass(frozen=True)
class Matrix:
    """Long matrix with its two sizes. A cell is present when an event touched it,
    even with 0 minutes; it counts as seen only with more than 0."""

    cells: DataFrame  # Customer_Key, Content_Key, Minutes
    users: int
    items: int
    cell_count: int

    @property
    def seen(self) -> DataFrame:
        return self.cells.filter(F.col("Minutes") > 0)


def sum_cells(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("Customer_Key", "Content_Key").agg(F.sum("Minutes_Watched").alias("Minutes"))


def build_matrix(events: DataFrame) -> Matrix:
    """Sum minutes per user and content and store the result, since similarities,
    scores, popularity and metrics all read it."""
    cells = materialize(sum_cells(normalize_events(events)), "matrix")
    sizes = cells.agg(
        F.count_distinct("Customer_Key"), F.count_distinct("Content_Key"), F.count("*")
    ).first()
    return Matrix(cells, *sizes)


def wide(matrix: Matrix, bound: int = WIDE_COLUMNS, contents: list | None = None) -> DataFrame:
    """Users by contents with a column each, 0 where nothing was watched.

    ``contents`` names the columns, in their order; every user keeps a row. Without it
    the columns are all contents, of which at most ``bound`` may exist; everything else
    in this package works on the long form.
    """
    items = contents
    if items is None:
        if matrix.items > bound:
            raise ValueError(f"{matrix.items} contents are too many columns")
        keys = matrix.cells.select("Content_Key").distinct().orderBy("Content_Key").collect()
        items = [row["Content_Key"] for row in keys]
    return (
        matrix.cells.groupBy("Customer_Key")
        .pivot("Content_Key", items)
        .agg(F.sum("Minutes"))
        .na.fill(0.0)
        .orderBy("Customer_Key")
    )


def wide_blocks(matrix: Matrix, width: int = WIDE_COLUMNS) -> Iterator[DataFrame]:
    """The wide matrix for any number of contents: stored tables of ``width`` contents each, the
    last of what is left, in the order of the content keys. Every user has a row in each.

    The driver holds the keys of one block at a time. Cells are stored by content first, so
    a block reads its own range of them; a content with a third of all cells is split by user.
    """
    by_content = ["Content_Key", "Customer_Key"]
    cells = materialize(matrix.cells.repartitionByRange(*by_content).sortWithinPartitions(*by_content), "by-content")
    users = materialize(cells.select("Customer_Key").distinct(), "users")
    contents = materialize(cells.select("Content_Key").distinct(), "contents")
    left = contents
    while items := [row["Content_Key"] for row in left.orderBy("Content_Key").limit(width).collect()]:
        block = (
            cells.filter(F.col("Content_Key").between(items[0], items[-1]))
            .groupBy("Customer_Key")
            .pivot("Content_Key", items)
            .agg(F.sum("Minutes"))
        )
        yield materialize(users.join(block, "Customer_Key", "left").na.fill(0.0), "wide")
        left = contents.filter(F.col("Content_Key") > items[-1])


def sparsity(matrix: Matrix) -> DataFrame:
    """Share of empty cells in percent, 0 for an empty matrix."""
    total = matrix.users * matrix.items
    share = (1 - F.count_if(F.col("Minutes") > 0) / F.lit(total)) * 100 if total else F.lit(0.0)
    return matrix.cells.agg(share.alias("Sparsity_Pct")).select(
        F.lit(matrix.users).cast("bigint").alias("Users"),
        F.lit(matrix.items).cast("bigint").alias("Items"),
        F.round("Sparsity_Pct", DIGITS).alias("Sparsity_Pct"),
    )


def popularity(matrix: Matrix) -> DataFrame:
    """Mean minutes per content over all users, those who never watched it included."""
    return matrix.cells.groupBy("Content_Key").agg(
        F.round(F.sum("Minutes") / F.lit(matrix.users), DIGITS).alias("Popularity")
    )


def user_means(matrix: Matrix) -> DataFrame:
    """Mean minutes over seen contents, 0 for a user who has seen none."""
    return matrix.cells.groupBy("Customer_Key").agg(
        F.coalesce(F.avg(F.when(F.col("Minutes") > 0, F.col("Minutes"))), F.lit(0.0)).alias("Mean_Minutes")
    )


def centred(matrix: Matrix) -> DataFrame:
    """Seen cells less their user's mean. Cells that fall on the mean carry nothing
    into a product and are left out; rounding makes equal cells fall on it exactly."""
    per_user = W.partitionBy("Customer_Key")
    return matrix.seen.select(
        "Customer_Key",
        "Content_Key",
        F.round(F.col("Minutes") - F.avg("Minutes").over(per_user), DIGITS).alias("Value"),
    ).filter(F.col("Value") != 0)

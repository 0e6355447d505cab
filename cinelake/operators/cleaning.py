"""Renaming, null handling, coercion and the closing steps of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.scalars import nan_to_null


def is_missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def clean_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every float column, array and struct of the table."""
    return df.select(
        *[nan_to_null(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value, found by one aggregate over the table."""
    counts = df.agg(
        *[F.count(F.when(~is_missing(df, c), 1)).alias(str(i)) for i, c in enumerate(df.columns)]
    ).first()
    empty = [c for i, c in enumerate(df.columns) if counts[i] == 0]
    return df.drop(*empty)


def finish(
    df: DataFrame,
    rename: dict[str, str] | None = None,
    columns: list[str] | None = None,
    dedup: bool = True,
    order: list[Column] | None = None,
) -> DataFrame:
    """Closing steps of a dataset: rename, choose columns, drop incomplete rows,
    drop repeated rows, sort."""
    out = df.withColumnsRenamed(rename) if rename else df
    if columns:
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    out = out.na.drop("any")
    if dedup:
        out = out.dropDuplicates()
    return out.orderBy(*order) if order else out


def first_by_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    A ``min`` over ordered structs instead of a window: it combines before the
    shuffle, so a key that holds a large part of the rows stays cheap. ``order``
    names columns of ``df``, read ascending.
    """
    rest = [c for c in df.columns if c != key]
    ranked = df.select(
        F.col(f"`{key}`"),
        F.struct(
            F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)]).alias("_order"),
            *[F.col(f"`{c}`") for c in rest],
        ).alias("_row"),
    )
    best = ranked.groupBy(key).agg(F.min("_row").alias("_row"))
    return best.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def map_values(df: DataFrame, column: str, mapping: dict, target: str) -> DataFrame:
    """Replace values through a small literal mapping; unmapped values give NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    table = F.create_map(*pairs)
    return df.withColumn(target, F.try_element_at(table, F.col(f"`{column}`")))

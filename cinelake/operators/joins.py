"""Look-ups from facts to dimensions.

No join here carries a broadcast hint on a table: the planner broadcasts a side
only when its measured size allows it, and otherwise sorts and merges with
skewed partitions split at run time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dim:
    """A dimension and how a fact reaches it.

    ``take`` maps dimension columns to the names they get on the joined row.
    """

    frame: DataFrame
    fact_key: str
    dim_key: str = "Key"
    take: dict[str, str] = field(default_factory=dict)


def same_key(left: Column, right: Column, null_safe: bool = True) -> Column:
    """Key equality. Null-safe: a missing key matches a missing key."""
    return left.eqNullSafe(right) if null_safe else left == right


def lookup_unwind(fact: DataFrame, dim: Dim, null_safe: bool = True, how: str = "inner") -> DataFrame:
    """Equi-join to one dimension, keeping the fact's columns and the ones taken."""
    right = dim.frame.select(
        F.col(f"`{dim.dim_key}`").alias("_dim_key"),
        *[F.col(f"`{source}`").alias(target) for source, target in dim.take.items()],
    )
    condition = same_key(fact[f"`{dim.fact_key}`"], right["_dim_key"], null_safe)
    return fact.join(right, condition, how).drop("_dim_key")


def star_join(fact: DataFrame, dims: list[Dim], null_safe: bool = True) -> DataFrame:
    for dim in dims:
        fact = lookup_unwind(fact, dim, null_safe)
    return fact


def nest_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, target: str) -> DataFrame:
    """Left outer look-up that stores the matches as an array of structs.

    For bridges and dimensions, whose matches per key fit a row. Where only numbers or the
    first of the matches are wanted, ``lookup_summary`` gets by without the array.
    """
    nested = right.groupBy(F.col(f"`{right_key}`").alias("_nest_key")).agg(
        F.array_sort(F.collect_list(F.struct("*"))).alias(target)
    )
    joined = left.join(nested, same_key(left[f"`{left_key}`"], nested["_nest_key"]), "left")
    return joined.drop("_nest_key").withColumn(target, F.coalesce(F.col(target), F.array()))


def lookup_summary(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    measures: dict[str, Column],
    without: dict[str, Column] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Left outer look-up that takes aggregates of the matches instead of the matches.

    ``measures`` are aggregates over the matching rows: how many there are, how many pass
    a condition, the first by some order. They are combined in the map tasks, so a key
    with any number of matches sends one row per task. ``without`` has the values of a
    row that finds nothing, 0 for a count.
    """
    per_key = right.groupBy(F.col(f"`{right_key}`").alias("_summary_key")).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    joined = left.join(per_key, same_key(left[f"`{left_key}`"], per_key["_summary_key"], null_safe), "left").drop("_summary_key")
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in (without or {}).items()})


def unwind(df: DataFrame, column: str) -> DataFrame:
    """One row per array element; rows with an empty or missing array vanish."""
    return df.withColumn(column, F.explode(column))


def drop_matching(df: DataFrame, keys: DataFrame, df_key: str, key: str) -> DataFrame:
    return df.join(keys, same_key(df[f"`{df_key}`"], keys[f"`{key}`"]), "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def lookup_or_default(df: DataFrame, dim: Dim, defaults: dict[str, Column]) -> DataFrame:
    """Left join, with a default for each taken column that found nothing."""
    out = lookup_unwind(df, dim, null_safe=False, how="left")
    return out.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})

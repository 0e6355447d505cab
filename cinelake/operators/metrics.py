"""Quality of recommendation lists and the numbers behind their charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalars import default_title, ratio_or_zero, shorten
from cinelake.operators.matrix import DIGITS, Matrix
from cinelake.operators.recommend import popular_contents

TOP_ITEMS = 10
SAMPLE_SIDE = 20
HISTOGRAM_BINS = 35


def list_metrics(lists: DataFrame, matrix: Matrix) -> DataFrame:
    """Users, coverage, totals, diversity, novelty and score range in one pass."""
    summed = lists.agg(
        F.count_distinct("Customer_Key").alias("covered"),
        F.count("*").alias("total"),
        F.count_distinct("Content_Key").alias("distinct_items"),
        F.count_if(F.col("Own_Minutes") == 0).alias("unseen"),
        F.avg("Score").alias("mean"),
        F.min("Score").alias("low"),
        F.max("Score").alias("high"),
    )
    users, items = F.lit(matrix.users).cast("bigint"), F.lit(matrix.items).cast("bigint")
    zero = F.lit(0.0)
    return summed.select(
        users.alias("Usuarios"),
        F.col("covered").alias("Usuarios_Con_Recomendaciones"),
        F.col("total").alias("Recomendaciones_Totales"),
        F.round(ratio_or_zero(F.col("total"), users), DIGITS).alias("Promedio_Usuario"),
        F.round(ratio_or_zero(F.col("distinct_items"), items), DIGITS).alias("Diversidad"),
        F.round(ratio_or_zero(F.col("unseen"), F.col("total")), DIGITS).alias("Novedad"),
        F.round(F.coalesce("mean", zero), 6).alias("Score_Medio"),
        F.coalesce("low", zero).alias("Score_Min"),
        F.coalesce("high", zero).alias("Score_Max"),
    )


def comparison_row(method: str, metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.lit(method).alias("Metodo"),
        "Usuarios",
        F.concat(
            F.col("Usuarios_Con_Recomendaciones").cast("string"), F.lit("/"), F.col("Usuarios").cast("string")
        ).alias("Cobertura"),
        "Recomendaciones_Totales",
        F.bround("Promedio_Usuario", 2).alias("Promedio_Usuario"),
        F.bround(F.col("Diversidad") * 100, 2).alias("Diversidad_Pct"),
        F.bround(F.col("Novedad") * 100, 2).alias("Novedad_Pct"),
        F.bround("Score_Medio", 2).alias("Score_Medio"),
    )


def compare_methods(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row per method."""
    return reduce(DataFrame.unionByName, [comparison_row(m, df) for m, df in metrics.items()])


def top_recommended(lists: DataFrame, titles: DataFrame, n: int = TOP_ITEMS, width: int = 34) -> DataFrame:
    """The contents that occur in most lists, with a shortened title."""
    top = (
        lists.groupBy("Content_Key")
        .agg(F.count("*").alias("Veces"))
        .orderBy(F.desc("Veces"), "Content_Key")
        .limit(n)
    )
    return (
        top.join(titles, "Content_Key", "left")
        .select(
            "Content_Key",
            shorten(F.coalesce("Titulo", default_title(F.col("Content_Key"))), width).alias("Titulo"),
            "Veces",
        )
        .orderBy(F.desc("Veces"), "Content_Key")
    )


def popular_submatrix(pairs: DataFrame, matrix: Matrix, side: int = SAMPLE_SIDE) -> DataFrame:
    """Similarity among the most popular contents, the diagonal left out. The pool
    has ``side`` rows, so both semi-joins are against a bounded table."""
    keys = F.broadcast(popular_contents(matrix, side).select("Content_Key"))
    return pairs.join(keys, pairs["a"] == keys["Content_Key"], "left_semi").join(
        keys, F.col("b") == keys["Content_Key"], "left_semi"
    )


def first_users_units(units: DataFrame, matrix: Matrix, side: int = SAMPLE_SIDE) -> DataFrame:
    """Vectors of the users with the lowest keys, for a small similarity sub-matrix."""
    first = matrix.cells.select("Customer_Key").distinct().orderBy("Customer_Key").limit(side)
    return units.join(F.broadcast(first), units["row"] == first["Customer_Key"], "left_semi")

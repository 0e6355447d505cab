"""The text catalogue: one title and one descriptive text per content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalars import default_title, flat_text, is_truthy, join_parts, whole_key
from cinelake.operators.cleaning import first_by_key

# Fields of a catalogue document, alternatives in order of preference.
KEY_FIELDS = ["Key", "Content Key", "Content_Key"]
TITLE_FIELDS = ["Title", "title"]
DESCRIPTION_FIELDS = ["Description", "description"]
TEXT_FIELDS = ["Categorias_Array", "Talento_Array", "Name", "Rating"]


def _exact_columns(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def _first_filled(df: DataFrame, names: list[str], otherwise: Column) -> Column:
    out = otherwise
    for name in reversed(_exact_columns(df, names)):
        column = F.col(f"`{name}`")
        out = F.when(is_truthy(column, df.schema[name].dataType), column.cast("string")).otherwise(out)
    return out


def _key(df: DataFrame) -> Column:
    """The first key field that is filled in must be a whole number; the row is
    skipped if not. The last field present is taken even if it is 0."""
    present = _exact_columns(df, KEY_FIELDS)
    if not present or (present[-1] != KEY_FIELDS[-1]):
        out = F.lit(None).cast("bigint")
    else:
        last = present.pop()
        out = whole_key(F.col(f"`{last}`"), df.schema[last].dataType)
    for name in reversed(present):
        column, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        out = F.when(is_truthy(column, dtype), whole_key(column, dtype)).otherwise(out)
    return out


def build_catalog(documents: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Content_Key, Titulo, Texto per document with a usable key.

    A key that occurs again keeps its first row by ``order`` (by title and text
    when no order is given), for the title as for the text.
    """
    title = _first_filled(documents, TITLE_FIELDS, default_title(F.col("_key")))
    description = _first_filled(documents, DESCRIPTION_FIELDS, F.lit(""))
    fields = [
        flat_text(F.col(f"`{n}`"), documents.schema[n].dataType)
        for n in _exact_columns(documents, TEXT_FIELDS)
    ]
    keyed = documents.withColumn("_key", _key(documents)).filter(F.col("_key").isNotNull())
    rows = keyed.select(
        F.col("_key").alias("Content_Key"),
        title.alias("Titulo"),
        join_parts([title, description, *fields], title).alias("Texto"),
        *[o.alias(f"_order{i}") for i, o in enumerate(order or [])],
    )
    sort = [F.col(f"_order{i}") for i in range(len(order or []))] + [F.col("Titulo"), F.col("Texto")]
    return first_by_key(rows, "Content_Key", sort).select("Content_Key", "Titulo", "Texto")


def uncatalogued(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Watched contents without a catalogue row."""
    return items.select("Content_Key").distinct().join(catalog.select("Content_Key"), "Content_Key", "left_anti")


def default_rows(keys: DataFrame) -> DataFrame:
    title = default_title(F.col("Content_Key"))
    return keys.select("Content_Key", title.alias("Titulo"), F.lower(title).alias("Texto"))


def complete_catalog(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """The catalogue and a default row for every watched content it lacks."""
    return catalog.unionByName(default_rows(uncatalogued(items, catalog)))


def align_catalog(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per watched content, described by the catalogue or by default."""
    watched = items.select("Content_Key").distinct()
    title = default_title(F.col("Content_Key"))
    return watched.join(catalog, "Content_Key", "left").select(
        "Content_Key",
        F.coalesce("Titulo", title).alias("Titulo"),
        F.coalesce("Texto", F.lower(title)).alias("Texto"),
    )

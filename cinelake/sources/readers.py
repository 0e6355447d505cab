"""Finding and reading tables."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


# Written and read alike: doubled quotes, blanks kept at the edges of a field.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

# What a missing field is read as, and no text is: else the empty text, in quotes, would be missing too.
_MISSING = "\x00missing\x00"


def read_table(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, kind: str | None = None
) -> DataFrame:
    """Read a Parquet, CSV or JSON path, told apart by ``kind`` or its extension (Parquet if none).

    JSON is one record per line. CSV fields may hold line breaks, so a CSV file is read by one
    task; ``read_csv_lines`` reads the form that splits.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    kind = kind or extension.removeprefix(".")
    if kind == "csv":
        return reader.options(**CSV_OPTIONS, multiLine="true", nullValue=_MISSING).csv(path)
    if kind == "json":
        return reader.json(path)
    return reader.parquet(path)


def escape_lines(text: Column) -> Column:
    """Text without line breaks: they, and the backslash, are spelled with a backslash."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(text: Column) -> Column:
    """The text that ``escape_lines`` spelled: pairs of backslashes part it, what is between has the others."""
    between = F.split(text, r"\\\\", -1)
    spelled = F.transform(
        between, lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(spelled, "\\")


def on_texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    texts = {f.name: change(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts) if texts else df


def read_csv_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Read what ``write_csv_lines`` wrote. A record is a line, so large files are split over the tasks."""
    return on_texts(spark.read.schema(schema).options(**CSV_OPTIONS, nullValue=_MISSING).csv(path), unescape_lines)


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Read files that hold one JSON array of records each.

    Such a file is parsed by one task, so this suits dimension files; line-wise
    JSON (``read_table``) is split over the cluster.
    """
    return spark.read.option("multiLine", True).schema(schema).json(path)


def _fits(found: T.StructType, wanted: T.StructType) -> bool:
    return {f.name.lower() for f in wanted} <= {f.name.lower() for f in found}


def read_first_available(
    spark: SparkSession, paths: list[str], schema: str | T.StructType
) -> DataFrame:
    """First path that can be read and has a row; a warning per miss, and an empty table when
    none has. One row of each candidate is read ahead, so a missing, damaged or empty file,
    or one without the columns asked for, falls through to the next."""
    wanted = spark.createDataFrame([], schema).schema
    for path in paths:
        try:
            if not path.rstrip("/").lower().endswith(".csv") and not _fits(read_table(spark, path).schema, wanted):
                log.warning("cannot read %s: columns are missing", path)
                continue
            table = read_table(spark, path, schema)
            if not table.isEmpty():
                return table
            log.warning("cannot read %s: it has no rows", path)
        except (PySparkException, Py4JJavaError) as miss:
            log.warning("cannot read %s: %s", path, str(miss).split("\n")[0])
    return spark.createDataFrame([], schema)


def resolve_table(spark: SparkSession, names: list[str]) -> DataFrame:
    """The first of ``names`` the session catalog knows, as a DataFrame."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    raise LookupError("no such table: " + ", ".join(names))


def resolve_columns(
    df: DataFrame, required: dict[str, list[str]], optional: dict[str, list[str]] | None = None
) -> DataFrame:
    """Rename aliased columns to their target names and keep only those.

    Raises ``ValueError`` naming every required target without a match.
    """
    present = set(df.columns)

    def pick(candidates: list[str]) -> str | None:
        return next((c for c in candidates if c in present), None)

    found = {target: pick(names) for target, names in required.items()}
    missing = [target for target, source in found.items() if source is None]
    if missing:
        raise ValueError("required columns not found: " + ", ".join(missing))
    for target, names in (optional or {}).items():
        source = pick(names)
        if source is not None:
            found[target] = source
    return df.select(*[F.col(f"`{source}`").alias(target) for target, source in found.items()])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"{what} has no rows")
    return df


def without_technical(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*(names or ("_id",)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(f"`{column}`").alias(column)).distinct()

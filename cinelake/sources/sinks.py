"""Writing results: JSON, CSV and batch exports with a report."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.operators.cleaning import clean_nan
from cinelake.session import shuffles_dropped
from cinelake.sources.readers import CSV_OPTIONS, escape_lines, on_texts

log = logging.getLogger(__name__)

# Exported files are gzipped, as plain text takes many times the tables it comes from. Such a file is
# read by one task, so it has a bounded number of rows.
EXPORT_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}

REPORT_SCHEMA = "Target STRING, Status STRING, Rows BIGINT, Detail STRING"


def _dates_as_text(df: DataFrame) -> DataFrame:
    def spell(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        return column

    return df.select(*[spell(f) for f in df.schema.fields])


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write ``df`` and tell its rows, counted on their way into the files."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_json(df: DataFrame, path: str, **options: str | int) -> int:
    """Line-wise UTF-8 JSON: NULL and NaN fields left out, dates spelled as text. Returns the rows."""
    return _counted(
        _dates_as_text(clean_nan(df)),
        lambda out: out.write.mode("overwrite").option("ignoreNullFields", True).options(**options).json(path),
    )


def write_csv(df: DataFrame, path: str, **options: str | int) -> int:
    """Quotes inside quoted fields are doubled, and blanks at the edges kept, as other tools
    expect; the empty text is a pair of quotes, a missing field nothing. Returns the rows."""
    return _counted(df, lambda out: out.write.mode("overwrite").options(**CSV_OPTIONS | options).csv(path))


def write_csv_lines(df: DataFrame, path: str) -> int:
    """CSV with one line per record: line breaks inside texts are escaped, so that files split
    when ``read_csv_lines`` reads them. Returns the rows."""
    return write_csv(on_texts(df, escape_lines), path)


def write_json_arrays(df: DataFrame, path: str, key: str, rows_per_file: int = 10_000) -> None:
    """Files that hold one JSON array of about ``rows_per_file`` records each, under ``path``."""
    files = max(1, -(-df.count() // rows_per_file))
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(files)).alias("_file")
    arrays = df.groupBy(bucket).agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("value"))
    arrays.repartition("_file").write.mode("overwrite").partitionBy("_file").text(path)


def _run_all(spark: SparkSession, jobs: dict[str, Callable[[], int | None]]) -> DataFrame:
    """Run each job; a failure is logged and reported, and the rest still run."""
    report = []
    for target, job in jobs.items():
        try:
            with shuffles_dropped(spark):
                rows = job()
            status = "skipped" if rows is None else "written"
            report.append((target, status, rows or 0, None))
        except Exception as failure:  # the point is that one bad table stops no other
            log.exception("export of %s failed", target)
            report.append((target, "failed", 0, str(failure)))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def export_tables(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str) -> DataFrame:
    """Clean every table and write it as gzipped JSON under its own name, skipping empty ones.

    Each table is computed once: the writer counts its rows and leaves out what is
    missing, columns without any value among it, and files without rows are taken away.
    """

    def job(name: str, df: DataFrame) -> Callable[[], int | None]:
        def run() -> int | None:
            path = f"{out_dir}/{name}"
            rows = write_json(df, path, **EXPORT_OPTIONS)
            if not rows:
                _remove(spark, path)
            return rows or None

        return run

    return _run_all(spark, {name: job(name, df) for name, df in tables.items()})


def export_datasets(
    spark: SparkSession, datasets: dict[str, Callable[[], DataFrame]], out_dir: str
) -> DataFrame:
    """Build every dataset and write it as gzipped CSV under its own name, once; the writer counts its rows."""
    jobs = {
        name: (lambda name=name, build=build: write_csv(build(), f"{out_dir}/{name}", **EXPORT_OPTIONS))
        for name, build in datasets.items()
    }
    return _run_all(spark, jobs)

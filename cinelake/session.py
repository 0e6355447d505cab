"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "cinelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans in this package count on.

    AQE re-plans joins from real sizes (a side is broadcast only when it
    measures below the threshold) and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return os.path.join(configured, f"cinelake-{app}")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="cinelake-")
    return _LOCAL_DIRS[app]


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute the rows by ``keys`` when the files yield fewer splits than there are cores.

    For scans whose rows are costly to work on (text, wide rows). A table of many
    splits is left as it is. Not for joined or grouped tables: counting their
    partitions would run them.
    """
    wanted = cores(df.sparkSession)
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)


def task_count(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for a stage that multiplies its rows. Given to ``repartition`` by
    number, because run-time coalescing judges by input size alone."""
    return max(cores(spark), -(-rows // per_task))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a write go when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def new_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where one result feeds several branches. The stored table survives the
    loss of executors, keeps column pruning, and gives the planner true sizes.
    """
    path = new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Secret scans with an incremental blob ledger.

Every text version is addressed by the SHA-256 of its content. The ledger, a Parquet
table, has one row per blob and rule version scanned so far, with its findings. A scan
reads only blobs that the ledger lacks under the current rules, each once whatever the
number of paths that hold it, appends them in one write, and joins findings back to all
paths. A write that fails leaves the ledger as it was.

NULL texts count as empty. Repeated rows are paths of their own. Spans are in code
points, end exclusive. A blob without findings is in the ledger too, with none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm.common import texts_of
from cinelake.session import materialize

# Kinds in their listed order: pattern, the group whose length counts, its least length.
# The first three are the contract's base kinds, the others formats in public use.
RULES: list[tuple[str, str, int, int]] = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    ("forge_token", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
]
BASE = ("assign", "access", "hex")

LEDGER = "blob binary, rules string, kinds array<int>, starts array<int>, ends array<int>"


def rules_version(rules: list[tuple[str, str, int, int]] = RULES) -> str:
    return hashlib.sha256(json.dumps(rules).encode()).hexdigest()[:16]


def _scan(rules: list[tuple[str, str, int, int]], version: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(re.compile(pattern, re.ASCII), group, least) for _, pattern, group, least in rules]
        for batch in batches:
            kinds, starts, ends = [], [], []
            for raw in texts_of(batch.column("text")):
                text = (raw or b"").decode("utf-8", "replace")
                found = sorted(
                    (m.start(), kind, m.end())
                    for kind, (pattern, group, least) in enumerate(compiled)
                    for m in pattern.finditer(text)
                    if m.end(group) - m.start(group) >= least
                )
                starts.append([f[0] for f in found])
                kinds.append([f[1] for f in found])
                ends.append([f[2] for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array([version] * batch.num_rows, pa.string())]
                + [pa.array(x, pa.list_(pa.int32())) for x in (kinds, starts, ends)],
                ["blob", "rules", "kinds", "starts", "ends"],
            )

    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, empty if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(
    docs: DataFrame, ledger: str, id_column: str = "doc_id", rules: list[tuple[str, str, int, int]] = RULES
) -> DataFrame:
    """Scan what ``ledger`` lacks; (id, kinds, starts, ends) of every row of ``docs``."""
    spark, version = docs.sparkSession, rules_version(rules)
    paths = docs.select(
        F.col(f"`{id_column}`").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("blob", F.unhex(F.sha2("text", 256)))
    versions = materialize(paths.select("path", "blob"), "versions")
    seen = read_ledger(spark, ledger).where(F.col("rules") == version).select("blob")
    # each unseen blob is read from one of its paths; texts are dealt once, as the join's
    # keys are never NULL and are those of the deduplication too
    place = F.xxhash64("path").alias("place")
    readers = versions.groupBy("blob").agg(F.min(F.xxhash64("path")).alias("place")).join(seen, "blob", "left_anti")
    once = paths.select("blob", place, "text").join(readers, ["place", "blob"]).dropDuplicates(["place", "blob"])
    once.select("blob", "text").mapInArrow(_scan(rules, version), LEDGER).write.mode("append").parquet(ledger)
    found = read_ledger(spark, ledger).where((F.col("rules") == version) & (F.size("kinds") > 0)).drop("rules")
    joined = versions.join(found, "blob", "left")
    none = F.array().cast("array<int>")
    return joined.select(
        F.col("path").alias(id_column), *[F.coalesce(c, none).alias(c) for c in ("kinds", "starts", "ends")]
    )


def _is(number: int):
    return lambda kind: kind == number


def digest(found: DataFrame, rules: list[tuple[str, str, int, int]] = RULES) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans, per row of ``scan``."""
    names = F.array(*[F.lit(r[0]) for r in rules])
    spelled = F.transform(
        F.arrays_zip("kinds", "starts", "ends"),
        lambda x: F.struct(
            x["kinds"].alias("kind"),
            F.concat_ws(":", F.get(names, x["kinds"]), x["starts"].cast("string"), x["ends"].cast("string")).alias("span"),
        ),
    )
    base = F.filter("all", lambda x: x["kind"] < len(BASE))
    counts = [F.size(F.filter("kinds", _is(n))).cast("long").alias(f"n_{r}") for n, r in enumerate(BASE)]
    kept = [c for c in found.columns if c not in ("kinds", "starts", "ends")]
    return found.withColumn("all", spelled).select(
        *kept, *counts,
        F.sha2(F.array_join(F.transform(base, lambda x: x["span"]), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("all", lambda x: x["span"]), ",").alias("spans"),
    )

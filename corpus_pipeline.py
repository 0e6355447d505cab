"""The corpus pipeline: five stages over the columns of ``documents``.

Each stage reads all its predecessor kept and is stored as Parquet before the next one.
NULL, empty and very long texts, repeated rows, empty tables and extra columns are
handled as the docstring of each stage's operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import decontaminate, language, line_dedup, near_duplicates, packing
from cinelake.llm.common import documents
from cinelake.session import materialize
from cinelake.sources.readers import read_table


# Columns that stages read by name; the others travel under names of our own, so none can clash.
_READ = ("doc_id", "text", "lang", "n_chars")


def _inner(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(c if c in _READ else f"c{n}") for n, c in enumerate(docs.columns)])


def _outer(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(c if c in _READ else f"c{n}").alias(c) for n, c in enumerate(docs.columns)])


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without text or any letter go."""
    model = language.prototypes(docs)
    inner = _inner(docs)
    found = language.identify(inner, model, inner.columns)
    return _outer(found.where(F.col("lang_pred") != language.UNKNOWN), docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, or nearly do, are cut; documents of nothing else go.
    ``n_chars`` is counted anew where a text changed."""
    before = _inner(docs).withColumn("before", F.col("text"))
    after = line_dedup.without_duplicate_lines(before, short=True)
    return _outer(_recounted(after, ~F.col("text").eqNullSafe(F.col("before"))), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the one with the least id, NULL ids last.
    Rows go by a key of id and text: different texts of one id are judged apart, and of rows that
    repeat both one stays. Rows without id and visible text are no copies and all stay."""
    row = F.struct(
        F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("at")
    )
    keyed = _inner(docs).withColumn("row", row)
    found = near_duplicates.near_duplicates(keyed, "row", width=5, share=(80, 100))
    gone = materialize(found.where("NOT kept").select(F.col("row").alias("gone")).distinct(), "gone")
    nothing = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    single = keyed.withColumn("single", F.when(nothing, F.monotonically_increasing_id()))
    kept = single.join(gone, F.col("row") == F.col("gone"), "left_anti")
    return _outer(kept.dropDuplicates(["row", "single"]), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; lesser spans of benchmark phrases are cut out of the others."""
    benchmark = read_table(spark, f"{sf_dir}/benchmark.parquet")
    inner = _inner(docs)
    found = decontaminate.scan(inner, benchmark, inner.columns, cleaned=True)
    return _outer(_recounted(found.where("NOT contaminated"), F.col("n_hit") > 0), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of at most 2048."""
    from public_tokenizers import path

    return packing.pack(packing.tokenize(docs, path("word_bpe_49k.json")))


def _recounted(docs: DataFrame, changed) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_copies),
    ("decontamination", decontaminated),
    ("best_fit_packing", sequences),
]

# Neither vector bundles, chosen paths nor a tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

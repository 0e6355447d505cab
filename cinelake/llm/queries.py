"""One query per operator: whole tables, production parameters, the full result."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import decontaminate, language, lexical, line_dedup, near_duplicates, ngram_model, packing, quality, secrets, sharding, suffix_dedup, toxicity
from cinelake.llm.common import documents, remainder
from cinelake.llm.manifest import manifest_sql, tampered_manifest
from cinelake.llm.registry import ORACLES, QUERIES, query
from cinelake.session import new_path
from cinelake.sources.readers import read_table

__all__ = ["ORACLES", "QUERIES"]

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
counts AS (SELECT x, count(*) AS n FROM shingles GROUP BY x HAVING count(*) > 1),
shared AS (SELECT doc_id, x FROM shingles JOIN counts USING (x)),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shared a JOIN shared b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), roots AS (SELECT doc_id, min(other) AS root FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(root, s.doc_id) AS component_id,
  coalesce(root, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN roots USING (doc_id)
"""

BENCHMARK_SQL = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_FOLDED}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), phrases AS (
  SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [w]
    ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS p
  FROM item_words
), lengths AS (SELECT DISTINCT len(p) AS n FROM phrases),
doc_words AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), firsts AS (SELECT DISTINCT p[1] AS first, len(p) AS n FROM phrases),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
tried AS (SELECT doc_id, i, n, w[i:i + n - 1] AS p FROM places JOIN firsts ON w[i] = first),
found AS (SELECT doc_id, i, t.n, item_id FROM tried t JOIN phrases USING (p)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SEARCH_SQL = rf"""
WITH asked AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_FOLDED}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), doc_words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_FOLDED}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), totals AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM doc_words WHERE len(w) > 0),
postings AS (
  SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM doc_words) GROUP BY ALL
), weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM postings, totals GROUP BY t, docs
), lengths AS (
  SELECT d, doc_id, 100 - 75 + (75 * len(w)::BIGINT * docs) // words AS m FROM doc_words, totals WHERE len(w) > 0
), scored AS (
  SELECT q, item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(w) AS t FROM asked) JOIN postings USING (t) JOIN weights USING (t) JOIN lengths USING (d)
  GROUP BY q, item_id, d, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

REPEATS_SQL = """
WITH bytes AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(hex(encode(text)), '') AS h FROM documents
), chunks AS (
  SELECT d, c, substr(h, 2 * c + 1, 2 * (1024 + 399)) AS s
  FROM (SELECT d, h, unnest(range(0, greatest(len(h) // 2 - 399, 0), 1024)) AS c FROM bytes)
), windows AS (
  SELECT d, c + i AS pos, md5_number(substr(s, (2 * i + 1)::INT, 800)) AS w
  FROM (SELECT d, c, s, unnest(range(0, least(1024, len(s) // 2 - 399))) AS i FROM chunks)
), repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (
  SELECT d, pos, lag(pos) OVER (PARTITION BY d ORDER BY pos) AS prior, lead(pos) OVER (PARTITION BY d ORDER BY pos) AS later
  FROM windows SEMI JOIN repeated USING (w)
), edges AS (
  SELECT d, pos AS start, NULL AS stop FROM hits WHERE prior IS NULL OR pos - prior > 400
  UNION ALL SELECT d, NULL, pos + 400 FROM hits WHERE later IS NULL OR later - pos > 400
), spans AS (
  SELECT d, unnest(list_zip(list_sort(list(start) FILTER (start IS NOT NULL)), list_sort(list(stop) FILTER (stop IS NOT NULL)))) AS s
  FROM edges GROUP BY d
), gaps AS (
  SELECT d, lag(s[2], 1, 0) OVER (PARTITION BY d ORDER BY s[1]) AS start, s[1] AS stop, s[2] - s[1] AS removed, s[2] AS past FROM spans
), cut AS (
  SELECT d, sum(removed)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, (2 * start + 1)::INT, (2 * (stop - start))::INT), '' ORDER BY start) || any_value(substr(h, (2 * last + 1)::INT)) AS rest
  FROM gaps JOIN bytes USING (d) JOIN (SELECT d, max(past) AS last FROM gaps GROUP BY d) USING (d) GROUP BY d
)
SELECT doc_id, len(h)::BIGINT // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (d)
"""


@query("op1_line_dedup")
def lines(spark: SparkSession, directory: str) -> DataFrame:
    return line_dedup.report(documents(spark, directory), short=True)


@query("op2_balanced_sharding")
def shards(spark: SparkSession, directory: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, directory))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_secret_scans")
def found_secrets(spark: SparkSession, directory: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, directory), new_path(spark, "ledger")))


@query("op4_ngram_scoring")
def scored(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).withColumn("held_out", remainder(F.col("doc_id"), 7) == 2)
    model = ngram_model.train(docs.where("NOT held_out"))
    found = ngram_model.score(docs, model, ["doc_id", "held_out"])
    return found.withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))


@query("op5_minhash_near_duplicates", NEAR_SQL)
def near(spark: SparkSession, directory: str) -> DataFrame:
    found = near_duplicates.near_duplicates(documents(spark, directory), width=3, share=(85, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op6_benchmark_decontamination", BENCHMARK_SQL)
def contamination(spark: SparkSession, directory: str) -> DataFrame:
    benchmark = read_table(spark, f"{directory}/benchmark.parquet")
    return decontaminate.scan(documents(spark, directory), benchmark, ["doc_id"])


@query("op7_toxicity")
def toxic(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    labels = read_table(spark, f"{directory}/labels.parquet").where(remainder(F.col("doc_id"), 3) != 1)
    machine = toxicity.train(docs, labels.withColumnRenamed("toxic", "label"))
    held = docs.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
    scored = toxicity.score(held, machine, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op8_quality_rules")
def good(spark: SparkSession, directory: str) -> DataFrame:
    return quality.judge(documents(spark, directory))


@query("op9_language_profiles")
def languages(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)
    model = language.prototypes(docs.where("NOT held_out"))
    return language.identify(docs, model, ["doc_id", "held_out"])


@query("op10_best_fit_packing")
def packed(spark: SparkSession, directory: str) -> DataFrame:
    from public_tokenizers import path

    pieces = packing.tokenize(documents(spark, directory), path("word_bpe_49k.json"))
    return packing.pack(pieces)


@query("op11_merkle_manifest", manifest_sql())
def proven(spark: SparkSession, directory: str) -> DataFrame:
    return tampered_manifest(documents(spark, directory))


@query("op12_ranked_search", SEARCH_SQL)
def ranked(spark: SparkSession, directory: str) -> DataFrame:
    return lexical.search(documents(spark, directory), read_table(spark, f"{directory}/benchmark.parquet"))


@query("op13_suffix_dedup", REPEATS_SQL)
def without_passages(spark: SparkSession, directory: str) -> DataFrame:
    found = suffix_dedup.without_repeats(documents(spark, directory))
    return found.select(
        "doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("pipeline")
def pipeline(spark: SparkSession, directory: str) -> DataFrame:
    return corpus_pipeline.run(spark, directory)

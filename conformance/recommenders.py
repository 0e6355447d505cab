"""Matrix, similarities, recommenders and their metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.operators import catalog, matrix as mx, metrics, pairwise, recommend, similarity, tfidf
from cinelake.plans import recommendations as plans
from cinelake.plans import registry
from cinelake.sources.retail_star import RetailStar
from conformance import case
from conformance.star_sql import NOVELTY, TABLES, cosine_sql, tokens_sql, weights_sql, with_tables


def matrix_of(spark, directory) -> mx.Matrix:
    return mx.build_matrix(RetailStar(spark, directory).viewing())


@case(
    "m9_event_normalizer",
    with_tables(
        "viewing",
        'SELECT u AS "Customer_Key", i AS "Content_Key", greatest(m, 0) AS "Minutes_Watched" FROM viewing',
    ),
)
def m9(spark, directory) -> DataFrame:
    return mx.normalize_events(RetailStar(spark, directory).viewing())


@case(
    "a10_matrix_cells",
    with_tables("cell", 'SELECT u AS "Customer_Key", i AS "Content_Key", round(m, 6) AS "Minutes" FROM cell'),
)
def a10_cells(spark, directory) -> DataFrame:
    return matrix_of(spark, directory).cells.withColumn("Minutes", F.round("Minutes", 6))


WIDE_ITEMS = range(100)  # every content of the click-stream


@case(
    "a10_matrix_wide",
    with_tables(
        "cell",
        'SELECT u AS "Customer_Key", '
        + ", ".join(f'round(coalesce(sum(m) FILTER (WHERE i = {i}), 0), 6) AS "{i}"' for i in WIDE_ITEMS)
        + " FROM cell GROUP BY u",
    ),
)
def a10_wide(spark, directory) -> DataFrame:
    out = mx.wide(matrix_of(spark, directory))
    return out.select("Customer_Key", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


BLOCK_WIDTH = 30


@case(
    "a10_matrix_blocks",
    with_tables(
        "viewing",
        f"""SELECT CAST((place - 1) // {BLOCK_WIDTH} AS INTEGER) AS "Block", (SELECT count(DISTINCT u) FROM viewing) AS "Rows",
        u AS "Customer_Key", CAST(i AS VARCHAR) AS "Content_Key", round(m, 6) AS "Minutes"
        FROM (SELECT u, i, sum(m) AS m, dense_rank() OVER (ORDER BY i) AS place FROM viewing GROUP BY u, i) WHERE m <> 0""",
    ),
)
def a10_blocks(spark, directory) -> DataFrame:
    """The cells of the stored blocks of the wide matrix, with each block's number and rows."""
    blocks = mx.wide_blocks(mx.build_matrix(RetailStar(spark, directory).viewing()), BLOCK_WIDTH)
    cells = [
        block.unpivot("Customer_Key", None, "Content_Key", "Minutes")
        .where("Minutes <> 0")
        .select(F.lit(n).alias("Block"), F.lit(block.count()).cast("bigint").alias("Rows"), "*")
        for n, block in enumerate(blocks)
    ]
    return reduce(DataFrame.unionByName, cells).withColumn("Minutes", F.round("Minutes", 6))


@case(
    "a11_sparsity",
    with_tables(
        "seen n_users n_items",
        """SELECT n_users.n AS "Users", n_items.n AS "Items",
        round((1 - (SELECT count(*) FROM seen) / (n_users.n * n_items.n)) * 100, 9) AS "Sparsity_Pct"
        FROM n_users, n_items""",
    ),
)
def a11(spark, directory) -> DataFrame:
    return mx.sparsity(matrix_of(spark, directory))


@case("a12_popularity", with_tables("popular", 'SELECT i AS "Content_Key", pop AS "Popularity" FROM popular'))
def a12(spark, directory) -> DataFrame:
    return mx.popularity(matrix_of(spark, directory))


@case(
    "a13_user_means",
    with_tables(
        "cell",
        """SELECT u AS "Customer_Key", round(coalesce(avg(m) FILTER (WHERE m > 0), 0), 6) AS "Mean_Minutes"
        FROM cell GROUP BY u""",
    ),
)
def a13(spark, directory) -> DataFrame:
    return mx.user_means(matrix_of(spark, directory)).withColumn("Mean_Minutes", F.round("Mean_Minutes", 6))


@case(
    "p23_centred_cells",
    with_tables("centred", 'SELECT u AS "Customer_Key", i AS "Content_Key", round(c, 6) AS "Value" FROM centred'),
)
def p23(spark, directory) -> DataFrame:
    return mx.centred(matrix_of(spark, directory)).withColumn("Value", F.round("Value", 6))


def _top(name: str) -> str:
    return f"""SELECT a AS "row", b AS "other", s AS "similarity" FROM (
        SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS rn FROM {name} WHERE s > 0)
        WHERE rn <= 20"""


@case("m12_raw_user_similarity", with_tables("sim_raw", _top("sim_raw")))
def m12(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.top_positive(similarity.raw_user_units(m), m.users, m.cell_count, 20)


@case("m13_centred_user_similarity", with_tables("sim_u", _top("sim_u")))
def m13(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.top_positive(similarity.centred_user_units(m), m.users, m.cell_count, 20)


@case(
    "w1_similar_users",
    with_tables("near_u", 'SELECT u AS "row", v AS "other", s AS "similarity" FROM near_u'),
)
def w1(spark, directory) -> DataFrame:
    return recommend.similar_users(matrix_of(spark, directory))


@case(
    "m14_item_similarity",
    with_tables("sim_i", 'SELECT a, b, s AS "similarity" FROM sim_i WHERE a < b AND s <> 0'),
)
def m14(spark, directory) -> DataFrame:
    return similarity.item_pairs(matrix_of(spark, directory))


def _stats_sql(name: str, size: str) -> str:
    return f"""
    SELECT n AS "Pairs", round(s / n, 6) AS "Mean", round(sqrt(greatest(q / n - (s / n) * (s / n), 0)), 6) AS "Std",
           CASE WHEN c < n THEN least(lo, 0.0) ELSE lo END AS "Min",
           CASE WHEN c < n THEN greatest(hi, 0.0) ELSE hi END AS "Max"
    FROM (SELECT count(*) AS c, sum(s) AS s, sum(s * s) AS q, min(s) AS lo, max(s) AS hi FROM {name} WHERE a < b)
    CROSS JOIN (SELECT CAST(k * (k - 1) // 2 AS BIGINT) AS n FROM (SELECT {size} AS k))"""


@case("m17_user_similarity_statistics", with_tables("sim_u n_users", _stats_sql("sim_u", "(SELECT n FROM n_users)")))
def m17_users(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_statistics(similarity.centred_user_units(m), m.users, m.cell_count)


@case("m17_raw_similarity_statistics", with_tables("sim_raw n_users", _stats_sql("sim_raw", "(SELECT n FROM n_users)")))
def m17_raw(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_statistics(similarity.raw_user_units(m), m.users, m.cell_count)


@case("m17_item_similarity_statistics", with_tables("sim_i n_items", _stats_sql("sim_i", "(SELECT n FROM n_items)")))
def m17_items(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_list_statistics(similarity.item_pairs(m), m.items)


@case("m17_text_similarity_statistics", with_tables("sim_t n_items", _stats_sql("sim_t", "(SELECT n FROM n_items)")))
def m17_texts(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    texts = plans.aligned_texts(m, RetailStar(spark, directory).catalog_documents())
    return pairwise.pair_list_statistics(plans.text_similarity(m, texts), m.items)


def _histogram_sql(name: str, size: str) -> str:
    # every pair of rows, those without a common feature at 0
    return f"""
    , every AS (
      SELECT coalesce(s, 0.0) AS s FROM (SELECT DISTINCT {size} AS k FROM cell) x
      JOIN (SELECT DISTINCT {size} AS k FROM cell) y ON x.k < y.k LEFT JOIN {name} ON a = x.k AND b = y.k),
    edge AS (SELECT min(s) AS lo, max(s) AS hi FROM every)
    SELECT CAST(bins.range AS INTEGER) AS "Bin", count(s) AS "Pairs"
    FROM range(35) bins LEFT JOIN (
      SELECT s, least(floor((s - lo) / (hi - lo) * 35), 34) AS bin FROM every, edge) ON bin = bins.range
    GROUP BY 1"""


def _with_histogram(tables: str, name: str, size: str) -> str:
    return with_tables(tables, _histogram_sql(name, size)).replace("\n\n", "\n")


@case("m24_raw_similarity_histogram", _with_histogram("sim_raw cell", "sim_raw", "u"))
def m24_raw(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_histogram(similarity.raw_user_units(m), m.users, m.cell_count, metrics.HISTOGRAM_BINS)


@case("m24_centred_similarity_histogram", _with_histogram("sim_u cell", "sim_u", "u"))
def m24_centred(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_histogram(similarity.centred_user_units(m), m.users, m.cell_count, metrics.HISTOGRAM_BINS)


@case("m24_item_similarity_histogram", _with_histogram("sim_i cell", "sim_i", "i"))
def m24_items(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return pairwise.pair_list_histogram(similarity.item_pairs(m), m.items, metrics.HISTOGRAM_BINS)


@case(
    "m24_popular_submatrix",
    with_tables(
        "sim_i popular",
        """SELECT a, b, s AS "similarity" FROM sim_i WHERE a < b AND s <> 0
        AND a IN (SELECT i FROM popular WHERE pos <= 20) AND b IN (SELECT i FROM popular WHERE pos <= 20)""",
    ),
)
def m24_submatrix(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return metrics.popular_submatrix(similarity.item_pairs(m), m)


@case(
    "t9_first_users_submatrix",
    with_tables(
        "sim_u cell",
        """SELECT a, b, s AS "similarity" FROM sim_u WHERE a < b AND s <> 0
        AND a IN (SELECT DISTINCT u FROM cell ORDER BY u LIMIT 20)
        AND b IN (SELECT DISTINCT u FROM cell ORDER BY u LIMIT 20)""",
    ),
)
def t9(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    units = metrics.first_users_units(similarity.centred_user_units(m), m)
    return pairwise.cosine_pairs(pairwise.gram(units, "row", "feature", "value", 20, 20 * m.items))


def _scores_sql(name: str) -> str:
    return with_tables(
        f"{name}_own",
        f'SELECT u AS "Customer_Key", i AS "Content_Key", round(score, 6) AS "Score" FROM {name}_own',
    )


def _scores(df: DataFrame) -> DataFrame:
    return df.select("Customer_Key", "Content_Key", F.round("Score", 6).alias("Score"))


@case("m18_user_user_scores", _scores_sql("lists_u"))
def m18(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return _scores(recommend.score_by_users(m, recommend.similar_users(m)))


@case("m19_item_item_scores", _scores_sql("lists_i"))
def m19(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return _scores(recommend.score_by_items(m, similarity.item_pairs(m)))


def _lists_sql(name: str) -> str:
    return with_tables(
        name,
        f"""SELECT u AS "Customer_Key", CAST(rn AS INTEGER) AS "Rank", i AS "Content_Key",
        round(score, 6) AS "Score", round(own, 6) AS "Own_Minutes" FROM {name}""",
    )


def _lists(df: DataFrame) -> DataFrame:
    return df.withColumns({"Score": F.round("Score", 6), "Own_Minutes": F.round("Own_Minutes", 6)})


@case("w2_user_user_lists", _lists_sql("lists_u"))
def w2_users(spark, directory) -> DataFrame:
    return _lists(plans.user_user(matrix_of(spark, directory)))


@case("w2_item_item_lists", _lists_sql("lists_i"))
def w2_items(spark, directory) -> DataFrame:
    return _lists(plans.item_item(matrix_of(spark, directory)))


@case("w2_text_lists", _lists_sql("lists_t"))
def w2_texts(spark, directory) -> DataFrame:
    return _lists(plans.by_text(matrix_of(spark, directory), RetailStar(spark, directory).catalog_documents()))


@case(
    "m20_popularity_fallback",
    with_tables(
        "popular cell",
        f"""SELECT u AS "Customer_Key", CAST(rn AS INTEGER) AS "Rank", i AS "Content_Key",
        round(score, 6) AS "Score" FROM (
          SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, pos) AS rn FROM (
            SELECT x.u, p.i, pos, round(pop * {NOVELTY.format('coalesce(m, 0)')}, 9) AS score
            FROM (SELECT DISTINCT u FROM cell) x JOIN popular p ON pos <= 30
            LEFT JOIN cell c ON c.u = x.u AND c.i = p.i)) WHERE rn <= 10""",
    ),
)
def m20(spark, directory) -> DataFrame:
    """Lists when no content could be scored at all."""
    m = matrix_of(spark, directory)
    nothing = spark.createDataFrame([], "Customer_Key BIGINT, Content_Key BIGINT, Score DOUBLE, Own_Minutes DOUBLE")
    return _lists(recommend.top_lists(nothing, m)).drop("Own_Minutes")


def _wide_sql(name: str) -> str:
    columns = ", ".join(
        f"""max(i) FILTER (WHERE rn = {p}) AS "Recomendacion_{p}_ContentKey",
        max(title) FILTER (WHERE rn = {p}) AS "Recomendacion_{p}_Titulo",
        round_even(max(score) FILTER (WHERE rn = {p}), 4) AS "Recomendacion_{p}_Score\""""
        for p in range(1, 11)
    )
    return with_tables(
        f"{name} aligned",
        f"""SELECT u AS "Customer_Key", count(*) AS "Num_Recomendaciones", {columns}
        FROM {name} JOIN aligned USING (i) GROUP BY u""",
    )


@case("q11_user_user_recommendations", _wide_sql("lists_u"))
def q11(spark, directory) -> DataFrame:
    return registry.MODELS["user_user_recommendations"](RetailStar(spark, directory))


@case("q12_item_item_recommendations", _wide_sql("lists_i"))
def q12(spark, directory) -> DataFrame:
    return registry.MODELS["item_item_recommendations"](RetailStar(spark, directory))


@case("q13_text_recommendations", _wide_sql("lists_t"))
def q13(spark, directory) -> DataFrame:
    return registry.MODELS["text_recommendations"](RetailStar(spark, directory))


def _metrics_sql(name: str) -> str:
    return f"""
    SELECT n_users.n AS "Usuarios", count(DISTINCT u) AS "Usuarios_Con_Recomendaciones",
           count(*) AS "Recomendaciones_Totales", round(count(*) / any_value(n_users.n), 9) AS "Promedio_Usuario",
           round(count(DISTINCT i) / any_value(n_items.n), 9) AS "Diversidad",
           round(count(*) FILTER (WHERE own = 0) / count(*), 9) AS "Novedad", round(avg(score), 6) AS "Score_Medio",
           min(score) AS "Score_Min", max(score) AS "Score_Max"
    FROM {name}, n_users, n_items GROUP BY n_users.n"""


@case("m22_user_user_metrics", with_tables("lists_u n_users n_items", _metrics_sql("lists_u")))
def m22(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    return metrics.list_metrics(plans.user_user(m), m)


def _comparison_sql() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{method}' AS "Metodo", "Usuarios",
        "Usuarios_Con_Recomendaciones" || '/' || "Usuarios" AS "Cobertura", "Recomendaciones_Totales",
        round_even("Promedio_Usuario", 2) AS "Promedio_Usuario", round_even("Diversidad" * 100, 2) AS "Diversidad_Pct",
        round_even("Novedad" * 100, 2) AS "Novedad_Pct", round_even("Score_Medio", 2) AS "Score_Medio"
        FROM ({_metrics_sql(name)})"""
        for method, name in ((plans.USER_USER, "lists_u"), (plans.ITEM_ITEM, "lists_i"), (plans.TEXT, "lists_t"))
    )
    return with_tables("lists_u lists_i lists_t n_users n_items", rows)


@case("q14_method_comparison", _comparison_sql())
def q14(spark, directory) -> DataFrame:
    return registry.MODELS["method_comparison"](RetailStar(spark, directory))


@case(
    "t7_top_recommended",
    with_tables(
        "lists_i aligned",
        """SELECT i AS "Content_Key", any_value(left(title, 34)) AS "Titulo", count(*) AS "Veces"
        FROM lists_i JOIN aligned USING (i) GROUP BY i ORDER BY count(*) DESC, i LIMIT 10""",
    ),
)
def t7(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    titles = catalog.build_catalog(RetailStar(spark, directory).catalog_documents()).drop("Texto")
    return metrics.top_recommended(plans.item_item(m), titles)


@case(
    "m10_catalog_texts",
    with_tables("catalog", 'SELECT i AS "Content_Key", title AS "Titulo", body AS "Texto" FROM catalog'),
)
def m10(spark, directory) -> DataFrame:
    return catalog.build_catalog(RetailStar(spark, directory).catalog_documents())


@case(
    "m11_aligned_catalog",
    with_tables("aligned", 'SELECT i AS "Content_Key", title AS "Titulo", body AS "Texto" FROM aligned'),
)
def m11(spark, directory) -> DataFrame:
    return plans.aligned_texts(matrix_of(spark, directory), RetailStar(spark, directory).catalog_documents())


@case(
    "u1_completed_catalog",
    with_tables(
        "catalog cell",
        """SELECT i AS "Content_Key", title AS "Titulo", body AS "Texto" FROM catalog
        UNION ALL SELECT DISTINCT i, 'Content ' || i, 'content ' || i FROM cell
        WHERE i NOT IN (SELECT i FROM catalog)""",
    ),
)
def u1(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    events = mx.normalize_events(star.viewing())
    return catalog.complete_catalog(events, catalog.build_catalog(star.catalog_documents()))


@case(
    "j11_uncatalogued_contents",
    with_tables(
        "catalog cell", 'SELECT DISTINCT i AS "Content_Key" FROM cell WHERE i NOT IN (SELECT i FROM catalog)'
    ),
)
def j11(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    return catalog.uncatalogued(mx.normalize_events(star.viewing()), catalog.build_catalog(star.catalog_documents()))


@case(
    "m16_text_similarity",
    with_tables("sim_t", 'SELECT a, b, s AS "similarity" FROM sim_t WHERE a < b AND s <> 0'),
)
def m16(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    texts = plans.aligned_texts(m, RetailStar(spark, directory).catalog_documents())
    return plans.text_similarity(m, texts)


TABLES["tokens_d"] = tokens_sql("doc_id", "text", "documents")
TABLES["weights_d"] = weights_sql("tokens_d", "(SELECT count(*) FROM documents)")
TABLES["vocabulary_d"] = """
    SELECT term, count(DISTINCT d) AS df, count(*) AS total FROM tokens_d GROUP BY 1
    ORDER BY count(*) DESC, term LIMIT 5000"""


@case(
    "f11_document_terms",
    "WITH tokens_d AS (" + TABLES["tokens_d"] + ') SELECT d AS "row", term, count(*) AS tf FROM tokens_d GROUP BY 1, 2',
)
def f11(spark, directory) -> DataFrame:
    return tfidf.term_counts(RetailStar(spark, directory).documents(), "doc_id", "text")


@case(
    "m15_document_vocabulary",
    "WITH tokens_d AS (" + TABLES["tokens_d"] + ") " + TABLES["vocabulary_d"],
)
def m15_vocabulary(spark, directory) -> DataFrame:
    documents = RetailStar(spark, directory).documents()
    return tfidf.vocabulary(tfidf.term_counts(documents, "doc_id", "text")).drop("feature")


@case(
    "m15_document_weights",
    "WITH tokens_d AS (" + TABLES["tokens_d"] + "), weights_d AS (" + TABLES["weights_d"]
    + ') SELECT d AS "row", term, round(x, 6) AS "value" FROM weights_d',
)
def m15(spark, directory) -> DataFrame:
    documents = RetailStar(spark, directory).documents()
    weighted, _ = plans.text_weights(documents, "doc_id", "text", documents.count())
    return weighted.select("row", "term", F.round("value", 6).alias("value"))


@case(
    "m16_similar_documents",
    "WITH tokens_d AS (" + TABLES["tokens_d"] + "), weights_d AS (" + TABLES["weights_d"] + "), sim_d AS ("
    + cosine_sql("weights_d", "d", "term", "x") + """) SELECT a AS "row", b AS "other", s AS "similarity" FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS rn FROM sim_d WHERE s > 0) WHERE rn <= 15""",
)
def m16_documents(spark, directory) -> DataFrame:
    """The 15 documents most similar to each document, over all words of all texts."""
    documents = RetailStar(spark, directory).documents()
    rows = documents.count()
    units, size = plans.text_weights(documents, "doc_id", "text", rows)
    return pairwise.top_positive(units, rows, size, recommend.SIMILAR_ITEMS)

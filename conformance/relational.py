"""Joins, aggregates, ranks, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalars import date_key
from cinelake.operators import cleaning, joins, matrix as mx, metrics, recommend, similarity
from cinelake.operators.joins import Dim
from cinelake.plans import recommendations, reports
from cinelake.sources.retail_star import RetailStar
from conformance import case
from conformance.recommenders import matrix_of
from conformance.star_sql import DATE_KEY, with_tables

# --- joins


@case(
    "j1_p2_p6_p7_nested_lookup",
    """SELECT p_partkey AS "Key", 2 AS matches, len(list_filter([p_brand, p_type], lambda x: x LIKE 'Brand%')) AS brands,
    least(p_brand, p_type) AS first_key FROM part WHERE p_type <> 'ECONOMY'
    UNION ALL SELECT p_partkey, 1, 1, p_brand FROM part WHERE p_type = 'ECONOMY' AND p_size > 25
    UNION ALL SELECT p_partkey, 0, 0, NULL FROM part WHERE p_type = 'ECONOMY' AND p_size <= 25""",
)
def j1(spark, directory) -> DataFrame:
    """Categories nested into contents; contents that have none keep an empty array."""
    star = RetailStar(spark, directory)
    economy = star.raw("part").filter(F.col("p_type") == "ECONOMY")
    small = economy.filter(F.col("p_size") <= 25).select("p_partkey")
    bridge = joins.drop_matching(
        star.content_category().filter(F.col("Category Key") != "ECONOMY"), small, "Content Key", "p_partkey"
    )
    key = F.col("Category Key")
    counts = {"matches": F.count("*").cast("int"), "brands": F.count_if(key.startswith("Brand")), "first_key": F.min(key)}
    none = {"matches": F.lit(0), "brands": F.lit(0).cast("bigint")}
    return joins.lookup_summary(star.content(), bridge, "Key", "Content Key", counts, none).select("Key", *counts)


@case(
    "j1_nested_arrays",
    """SELECT p_partkey AS "Key", array_to_string(list_sort([p_brand, p_type]), ', ') AS names FROM part""",
)
def j1_arrays(spark, directory) -> DataFrame:
    """Categories nested into contents as arrays of structs."""
    star = RetailStar(spark, directory)
    nested = joins.nest_lookup(star.content(), star.content_category(), "Key", "Content Key", "Categorias")
    return nested.select("Key", F.array_join(F.transform("Categorias", lambda c: c["Category Key"]), ", ").alias("names"))


@case(
    "j2_inner_lookup",
    with_tables("cust geography", 'SELECT c."Key", g."City" FROM cust c JOIN geography g ON c."Geography Key" = g."Key"'),
)
def j2(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    return joins.lookup_unwind(star.customer(), Dim(star.geography(), "Geography Key", take={"City": "City"})).select(
        "Key", "City"
    )


_NULL_KEYS = """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS k FROM orders"""
_NULL_DIM = """
    SELECT DISTINCT nullif(o_orderstatus, 'P') AS k, 'status ' || o_orderstatus AS label FROM orders"""


@case(
    "j3_null_safe_lookup",
    f"SELECT o.o_orderkey, d.label FROM ({_NULL_KEYS}) o JOIN ({_NULL_DIM}) d ON o.k IS NOT DISTINCT FROM d.k",
)
def j3(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders")
    status = F.nullif("o_orderstatus", F.lit("P"))
    facts = orders.select("o_orderkey", status.alias("k"))
    dim = orders.select(status.alias("k"), F.concat(F.lit("status "), "o_orderstatus").alias("label")).distinct()
    return joins.lookup_unwind(facts, Dim(dim, "k", "k", {"label": "label"})).select("o_orderkey", "label")


@case(
    "j3_plain_lookup",
    f"SELECT o.o_orderkey, d.label FROM ({_NULL_KEYS}) o JOIN ({_NULL_DIM}) d ON o.k = d.k",
)
def j3_plain(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders")
    status = F.nullif("o_orderstatus", F.lit("P"))
    facts = orders.select("o_orderkey", status.alias("k"))
    dim = orders.select(status.alias("k"), F.concat(F.lit("status "), "o_orderstatus").alias("label")).distinct()
    return joins.lookup_unwind(facts, Dim(dim, "k", "k", {"label": "label"}), null_safe=False).select(
        "o_orderkey", "label"
    )


@case("j4_unwind", "SELECT doc_id, w FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)")
def j4(spark, directory) -> DataFrame:
    """Words of all texts; a text without an array would vanish."""
    documents = RetailStar(spark, directory).raw("documents")
    return joins.unwind(documents.select("doc_id", F.split("text", " ", -1).alias("w")), "w")


@case(
    "j5_anti_join",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def j5(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    pending = star.raw("orders").filter(F.col("o_orderstatus") == "P").select("o_custkey")
    return joins.drop_matching(star.raw("customer").select("c_custkey"), pending, "c_custkey", "o_custkey")


_LAST_DATES = "SELECT DISTINCT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 30"


@case("j6_p5_recent_events", f"SELECT o_orderkey FROM orders WHERE o_orderdate IN ({_LAST_DATES})")
def j6(spark, directory) -> DataFrame:
    """Events on the last 30 registered dates; the date list has 30 rows at most."""
    orders = RetailStar(spark, directory).raw("orders").select("o_orderkey", F.col("o_orderdate").alias("Date Key"))
    recent = F.broadcast(reports.recent_dates(orders))
    return orders.join(recent, "Date Key", "left_semi").select("o_orderkey")


@case(
    "j7_bridge_join",
    with_tables(
        "bridge category",
        """SELECT t."Name", count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS streams
        FROM lineitem JOIN bridge b ON l_partkey = "Content Key" JOIN category t ON b."Category Key" = t."Key"
        GROUP BY 1""",
    ),
)
def j7(spark, directory) -> DataFrame:
    """Streams per category. Lines are summed per content before the bridge repeats them."""
    star = RetailStar(spark, directory)
    per_content = star.content_event().groupBy("Content Key").agg(
        F.count("*").alias("n"), F.sum("Streams Count").alias("streams")
    )
    named = joins.lookup_unwind(star.content_category(), Dim(star.category(), "Category Key", take={"Name": "Name"}))
    return (
        joins.lookup_unwind(per_content, Dim(named, "Content Key", "Content Key", {"Name": "Name"}))
        .groupBy("Name")
        .agg(F.sum("n").alias("n"), F.sum("streams").alias("streams"))
    )


@case(
    "j8_star_join",
    with_tables(
        "event cust geography content provider",
        """SELECT g."Country", t."Release Year" AS year, p."Type", count(*) AS n
        FROM event e JOIN cust c ON e."Customer Key" = c."Key" JOIN geography g ON c."Geography Key" = g."Key"
        JOIN content t ON e."Content Key" = t."Key" JOIN provider p ON e."Provider Key" = p."Key"
        GROUP BY 1, 2, 3""",
    ),
)
def j8(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    placed = joins.lookup_unwind(star.customer(), Dim(star.geography(), "Geography Key", take={"Country": "Country"}))
    joined = joins.star_join(
        star.event(),
        [
            Dim(placed, "Customer Key", take={"Country": "Country"}),
            Dim(star.content(), "Content Key", take={"Release Year": "year"}),
            Dim(star.provider(), "Provider Key", take={"Type": "Type"}),
        ],
    )
    return joined.groupBy("Country", "year", "Type").agg(F.count("*").alias("n"))


@case(
    "j9_reindex",
    """SELECT user_id AS "Key", c_name AS "Name" FROM (SELECT DISTINCT user_id * 20 AS user_id FROM events)
    LEFT JOIN customer ON user_id = c_custkey""",
)
def j9(spark, directory) -> DataFrame:
    """Keys of one table with attributes of another, missing where there are none."""
    star = RetailStar(spark, directory)
    keys = star.raw("events").select((F.col("user_id") * 20).alias("Key")).distinct()
    return joins.lookup_unwind(
        keys, Dim(star.raw("customer"), "Key", "c_custkey", {"c_name": "Name"}), null_safe=False, how="left"
    )


@case(
    "j10_lookup_with_default",
    """SELECT user_id AS "Key", coalesce(c_name, 'Content ' || user_id) AS "Name"
    FROM (SELECT DISTINCT user_id * 20 AS user_id FROM events) LEFT JOIN customer ON user_id = c_custkey""",
)
def j10(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    keys = star.raw("events").select((F.col("user_id") * 20).alias("Key")).distinct()
    title = F.concat(F.lit("Content "), F.col("Key").cast("string"))
    return joins.lookup_or_default(keys, Dim(star.raw("customer"), "Key", "c_custkey", {"c_name": "Name"}), {"Name": title})


# --- aggregates


@case(
    "a1_a2_group_sum_and_count",
    """SELECT l_returnflag, coalesce(CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS BIGINT), 0) AS streams,
    count(*) AS n FROM lineitem GROUP BY 1""",
)
def a1(spark, directory) -> DataFrame:
    """A group without a single value sums to 0."""
    lines = RetailStar(spark, directory).raw("lineitem").withColumn(
        "streams", F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint"))
    )
    return lines.groupBy("l_returnflag").agg(reports.total("streams").alias("streams"), F.count("*").alias("n"))


@case("a3_composite_group", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a3(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@case(
    "a4_two_level_aggregation",
    """SELECT c_nationkey, count(*) AS orders, round(sum(o_totalprice), 2) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def a4(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    per_customer = star.raw("orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("amount")
    )
    joined = joins.lookup_unwind(
        per_customer, Dim(star.raw("customer"), "o_custkey", "c_custkey", {"c_nationkey": "c_nationkey"})
    )
    return joined.groupBy("c_nationkey").agg(
        F.sum("orders").alias("orders"), F.round(F.sum("amount"), 2).alias("amount")
    )


@case("a5_average", "SELECT user_id, round(avg(CASE WHEN value > 10 THEN value END), 6) AS mean FROM events GROUP BY 1")
def a5(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("events").groupBy("user_id").agg(
        F.round(F.avg(F.when(F.col("value") > 10, F.col("value"))), 6).alias("mean")
    )


@case(
    "a8_arg_max_and_min",
    """SELECT (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most,
    (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*), 1 LIMIT 1) AS least""",
)
def a8(spark, directory) -> DataFrame:
    counts = RetailStar(spark, directory).raw("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return counts.agg(
        F.max_by("o_custkey", F.struct("n", -F.col("o_custkey"))).alias("most"),
        F.min_by("o_custkey", F.struct("n", "o_custkey")).alias("least"),
    )


@case(
    "a9_w5_value_counts_and_share",
    """SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct
    FROM orders GROUP BY 1""",
)
def a9(spark, directory) -> DataFrame:
    """Share of the total; the total comes from the few counted rows."""
    counts = RetailStar(spark, directory).raw("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(F.col("n") / counts.agg(F.sum("n")).scalar() * 100, 6))


@case(
    "a15_weighted_mean",
    """SELECT l_partkey, CASE WHEN sum(l_discount) > 0 THEN round(sum(l_quantity * l_discount) / sum(l_discount), 6) END AS mean
    FROM lineitem GROUP BY 1""",
)
def a15(spark, directory) -> DataFrame:
    weight, value = F.col("l_discount"), F.col("l_quantity")
    mean = F.round(F.sum(value * weight) / F.sum(weight), 6)
    return RetailStar(spark, directory).raw("lineitem").groupBy("l_partkey").agg(
        F.when(F.sum(weight) > 0, mean).alias("mean")
    )


@case("a16_minimum_support", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 3")
def a16(spark, directory) -> DataFrame:
    counts = RetailStar(spark, directory).raw("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= recommend.MIN_VIEWERS)


@case("a17_recommended_item_frequency", with_tables("lists_u", 'SELECT i AS "Content_Key", count(*) AS n FROM lists_u GROUP BY 1'))
def a17(spark, directory) -> DataFrame:
    return recommendations.user_user(matrix_of(spark, directory)).groupBy("Content_Key").agg(F.count("*").alias("n"))


@case(
    "a18_a19_a20_item_item_metrics",
    with_tables(
        "lists_i n_users n_items",
        """SELECT count(DISTINCT u) AS covered, count(*) FILTER (WHERE own = 0) AS unseen,
        round(count(DISTINCT i) / any_value(n_items.n), 6) AS diversity, round(avg(score), 6) AS mean
        FROM lists_i, n_items""",
    ),
)
def a18(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    measured = metrics.list_metrics(recommendations.item_item(m), m)
    return measured.select(
        F.col("Usuarios_Con_Recomendaciones").alias("covered"),
        F.round(F.col("Novedad") * F.col("Recomendaciones_Totales")).cast("bigint").alias("unseen"),
        F.round("Diversidad", 6).alias("diversity"),
        F.col("Score_Medio").alias("mean"),
    )


@case("a22_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def a22(spark, directory) -> DataFrame:
    return cleaning.finish(
        RetailStar(spark, directory).raw("lineitem"), columns=["l_returnflag", "l_linestatus", "l_quantity", "l_tax"]
    )


@case(
    "a23_first_row_per_key",
    f"""SELECT o_custkey, o_orderkey, {DATE_KEY.format('o_orderdate')} AS day FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1""",
)
def a23(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").select(
        "o_custkey", "o_orderkey", date_key(F.col("o_orderdate")).alias("day")
    )
    return cleaning.first_by_key(orders, "o_custkey", [F.col("day"), F.col("o_orderkey")])


@case(
    "a24_minimum_total",
    with_tables("cell", 'SELECT u AS "Customer_Key", sum(m) >= 50 AS active FROM cell GROUP BY 1'),
)
def a24(spark, directory) -> DataFrame:
    totals = recommend.user_totals(matrix_of(spark, directory))
    return totals.select("Customer_Key", (F.col("Total_Minutes") >= recommend.MIN_USER_MINUTES).alias("active"))


# --- ranks, sorts, top-k


@case(
    "w3_position_in_list",
    with_tables("lists_u", 'SELECT u AS "Customer_Key", count(*) AS n, CAST(max(rn) AS INTEGER) AS last FROM lists_u GROUP BY 1'),
)
def w3(spark, directory) -> DataFrame:
    return (
        recommendations.user_user(matrix_of(spark, directory))
        .groupBy("Customer_Key")
        .agg(F.count("*").alias("n"), F.max("Rank").alias("last"))
    )


@case("t2_top_20", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t2(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@case(
    "t3_last_30_distinct",
    f"""SELECT DISTINCT {DATE_KEY.format('o_orderdate')} AS "Date Key" FROM orders ORDER BY 1 DESC LIMIT 30""",
)
def t3(spark, directory) -> DataFrame:
    return reports.recent_dates(RetailStar(spark, directory).activity())


@case("t1_t4_t5_sorted_rows", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def t4(spark, directory) -> DataFrame:
    customers = RetailStar(spark, directory).raw("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return cleaning.finish(customers, dedup=False, order=[F.asc("c_nationkey"), F.desc("c_acctbal"), F.asc("c_custkey")])


@case(
    "t8_popular_similarities",
    with_tables(
        "sim_i popular",
        """SELECT a AS "Content_Key", count(*) AS n, round(max(s), 6) AS best FROM sim_i WHERE s <> 0
        AND a IN (SELECT i FROM popular WHERE pos <= 20) AND b IN (SELECT i FROM popular WHERE pos <= 20) GROUP BY 1""",
    ),
)
def t8(spark, directory) -> DataFrame:
    m = matrix_of(spark, directory)
    sub = similarity.both_ways(metrics.popular_submatrix(similarity.item_pairs(m), m))
    return sub.groupBy(F.col("item").alias("Content_Key")).agg(
        F.count("*").alias("n"), F.round(F.max("similarity"), 6).alias("best")
    )


# --- sets


@case("u2_key_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT user_id FROM events")
def u2(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    parts = star.raw("part").select(F.col("p_partkey").alias("k"))
    return joins.key_difference(parts, star.raw("events").select(F.col("user_id").alias("k")), "k")


@case(
    "u3_all_but_extremes",
    """SELECT c_nationkey FROM customer GROUP BY 1 HAVING c_nationkey NOT IN (
      (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
      (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*), 1 LIMIT 1))""",
)
def u3(spark, directory) -> DataFrame:
    counts = RetailStar(spark, directory).raw("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    most = counts.agg(F.max_by("c_nationkey", F.struct("n", -F.col("c_nationkey"))).alias("k")).scalar()
    least = counts.agg(F.min_by("c_nationkey", F.struct("n", F.col("c_nationkey"))).alias("k")).scalar()
    return counts.filter((F.col("c_nationkey") != most) & (F.col("c_nationkey") != least)).select("c_nationkey")


@case("u4_union_of_summaries", """
    SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events""")
def u4(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    rows = [
        star.raw(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        for name in ("orders", "events")
    ]
    return rows[0].unionByName(rows[1])

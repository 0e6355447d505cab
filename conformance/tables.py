"""Reading, cleaning and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions import scalars as fn
from cinelake.operators import cleaning
from cinelake.plans import registry
from cinelake.session import new_path
from cinelake.sources import readers, schemas, sinks
from cinelake.sources.retail_star import RetailStar
from conformance import case
from conformance.reports import Q5, Q5_TABLES, SQLS
from conformance.star_sql import TABLES, with_tables


@case("s1_table_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s1(spark, directory) -> DataFrame:
    return readers.read_table(spark, f"{directory}/supplier.parquet")


@case("s2_scan_without_technical_column", "SELECT o_orderkey, o_custkey FROM orders")
def s2(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").select("o_orderkey", "o_custkey")
    return readers.without_technical(orders.withColumn("_id", F.col("o_orderkey")))


@case(
    "s3_required_rows",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
)
def s3(spark, directory) -> DataFrame:
    events = readers.require_rows(RetailStar(spark, directory).raw("events"), "events")
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


@case("s4_distinct_values", "SELECT DISTINCT o_orderstatus FROM orders")
def s4(spark, directory) -> DataFrame:
    return readers.distinct_values(RetailStar(spark, directory).raw("orders"), "o_orderstatus")


@case("s5_resolve_table", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s5(spark, directory) -> DataFrame:
    names = schemas.TABLE_NAMES["event"]
    RetailStar(spark, directory).raw("events").createOrReplaceTempView(names[-2])
    return readers.resolve_table(spark, names).groupBy("event_type").agg(F.count("*").alias("n"))


@case("s6_resolve_columns", with_tables("viewing", 'SELECT u AS "Customer_Key", m AS "Minutes_Watched" FROM viewing'))
def s6(spark, directory) -> DataFrame:
    events = RetailStar(spark, directory).viewing().withColumnRenamed("Customer Key", "customerKey")
    return readers.resolve_columns(
        events,
        {c: schemas.EVENT_ALIASES[c] for c in ("Customer_Key", "Minutes_Watched")},
        {"Streams_Count": schemas.EVENT_ALIASES["Streams_Count"]},
    )


@case("s7_first_available_file", "SELECT p_partkey, p_name, p_size FROM part")
def s7(spark, directory) -> DataFrame:
    paths = [f"{directory}/no_such_part.parquet", f"{directory}/part.parquet"]
    return readers.read_first_available(spark, paths, "p_partkey BIGINT, p_name STRING, p_size INT")


@case("s8_json_array_table", with_tables("geography", "SELECT * FROM geography"))
def s8(spark, directory) -> DataFrame:
    """The city dimension, stored as files of one JSON array each and read back."""
    path = new_path(spark, "geography-array")
    sinks.write_json_arrays(RetailStar(spark, directory).geography(), path, "Key", 7)
    return readers.read_json_array(spark, path, "Key BIGINT, City STRING, Country STRING").select("Key", "City", "Country")


@case(
    "s9_json_round_trip",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
    nullif(o_totalprice, 0.0) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
    FROM orders""",
)
def s9(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        "o_totalprice",
        "o_orderdate",
    )
    path = new_path(spark, "orders") + ".json"
    sinks.write_json(orders, path)
    return readers.read_table(
        spark, path, "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE, o_orderdate STRING"
    )


@case("s10_csv_round_trip", with_tables(Q5_TABLES, f'SELECT DISTINCT "Pais", "Ciudad", "Ingreso_Total" AS '
      f'"Ingreso_Total_Suscriptores", "Total_Pagos" AS "Total_Pagos_Registrados", "Total_Impuestos", '
      f'"Total_Descuentos" FROM ({Q5})'))
def s10(spark, directory) -> DataFrame:
    dataset = registry.dataset("income_by_city", RetailStar(spark, directory))
    path = new_path(spark, "income") + ".csv"
    sinks.write_csv(dataset, path)
    return readers.read_table(spark, path, dataset.schema)


@case(
    "s10_csv_text_round_trip",
    """SELECT 'd' AS kind, doc_id AS id, text, lang AS note FROM documents
    UNION ALL SELECT 'p', page_id, html, '' FROM pages""",
)
def s10_texts(spark, directory) -> DataFrame:
    """Texts with line breaks, quotes and nothing in them, as CSV of one record per line."""
    texts = readers.read_table(spark, f"{directory}/documents.parquet").select(
        F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text", F.col("lang").alias("note")
    )
    pages = readers.read_table(spark, f"{directory}/pages.parquet").select(
        F.lit("p").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"), F.lit("").alias("note")
    )
    both = texts.unionByName(pages)
    path = new_path(spark, "texts") + ".csv"
    sinks.write_csv_lines(both, path)
    return readers.read_csv_lines(spark, path, both.schema)


STAR_TABLES = ["availability", "category", "content", "content_category", "content_talent", "customer", "date", "event",
               "geography", "language", "payment", "payment_method", "plan", "provider", "subscription", "talent"]
_COUNTED = {
    "content_talent": "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)",
    "date": "(SELECT DISTINCT o_orderdate::DATE FROM orders)",
    "language": "(SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)",
    "payment_method": "(SELECT DISTINCT o_orderpriority FROM orders)",
    "talent": "supplier",
}
_SQL_NAMES = {"content_category": "bridge", "customer": "cust"}


@case(
    "s12_export_tables",
    with_tables(
        " ".join(_SQL_NAMES.get(t, t) for t in STAR_TABLES if t not in _COUNTED),
        " UNION ALL ".join(
            f"""SELECT '{t}' AS "Target", 'written' AS "Status", count(*) AS "Rows", CAST(NULL AS VARCHAR) AS "Detail"
            FROM {_COUNTED.get(t, _SQL_NAMES.get(t, t))}"""
            for t in STAR_TABLES
        )
        + """ UNION ALL SELECT 'empty', 'skipped', 0, NULL""",
    ),
)
def s12(spark, directory) -> DataFrame:
    star = RetailStar(spark, directory)
    tables = {name: getattr(star, name)() for name in STAR_TABLES}
    tables["empty"] = star.customer().filter(F.col("Key") < 0)
    return sinks.export_tables(spark, tables, new_path(spark, "export"))


def _datasets_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "Target", 'written' AS "Status", (SELECT count(*) FROM ({SQLS[name][2]})) AS "Rows",
        CAST(NULL AS VARCHAR) AS "Detail\""""
        for name in registry.QUERIES
    )


@case("s13_export_datasets", _datasets_sql())
def s13(spark, directory) -> DataFrame:
    return registry.generate_datasets(RetailStar(spark, directory), new_path(spark, "datasets"))


@case(
    "q15_clean_and_export",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type,
    CASE WHEN value > 1 THEN value END AS value FROM events""",
)
def q15(spark, directory) -> DataFrame:
    """Drop empty columns, turn NaN into nothing, write JSON, read it back."""
    events = RetailStar(spark, directory).raw("events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.when(F.col("value") > 1, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"),
        F.col("props").try_cast("double").alias("unused"),
    )
    path = new_path(spark, "events") + ".json"
    cleaned = cleaning.drop_all_null_columns(events)
    sinks.write_json(cleaned, path)
    return readers.read_table(
        spark, path, "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE"
    ).select([c for c in cleaned.columns])


# --- projection, filter, cleaning


@case("p1_project", "SELECT s_suppkey AS \"Key\", s_name AS \"Name\" FROM supplier")
def p1(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).provider().select("Key", "Name")


@case("p3_add_column", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def p3(spark, directory) -> DataFrame:
    lines = RetailStar(spark, directory).raw("lineitem")
    return lines.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))).select(
        "l_orderkey", "l_linenumber", "net"
    )


@case("p4_equality_filter", with_tables("cust", 'SELECT "Key", "Is Active" FROM cust WHERE "Is Active"'))
def p4(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).customer().filter(F.col("Is Active")).select("Key", "Is Active")


@case("p8_rename", 'SELECT c_custkey AS "Cliente_ID", c_name AS "Nombre" FROM customer')
def p8(spark, directory) -> DataFrame:
    customers = RetailStar(spark, directory).raw("customer").select("c_custkey", "c_name")
    return customers.withColumnsRenamed({"c_custkey": "Cliente_ID", "c_name": "Nombre"})


_SPARSE_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
           CASE WHEN o_totalprice > 200000 THEN o_totalprice END AS price FROM orders"""


def _sparse(spark, directory) -> DataFrame:
    """Orders with missing states, and prices missing as NaN."""
    return RetailStar(spark, directory).raw("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("price"),
    )


@case("p9_p10_complete_rows", f"SELECT o_orderkey, price FROM ({_SPARSE_SQL}) WHERE status IS NOT NULL AND price IS NOT NULL")
def p10(spark, directory) -> DataFrame:
    return cleaning.finish(_sparse(spark, directory), dedup=False).select("o_orderkey", "price")


@case("p11_complete_keys", f"SELECT * FROM ({_SPARSE_SQL}) WHERE status IS NOT NULL")
def p11(spark, directory) -> DataFrame:
    return cleaning.clean_nan(_sparse(spark, directory).na.drop(subset=["status"]))


@case("p12_fill_constant", f"SELECT o_orderkey, coalesce(status, '-') AS status, coalesce(price, 0) AS price FROM ({_SPARSE_SQL})")
def p12(spark, directory) -> DataFrame:
    return _sparse(spark, directory).na.fill({"status": "-", "price": 0.0})


@case("p13_fill_from_expression", f"SELECT o_orderkey, coalesce(status, 'Content ' || o_orderkey) AS status FROM ({_SPARSE_SQL})")
def p13(spark, directory) -> DataFrame:
    title = fn.default_title(F.col("o_orderkey"))
    return _sparse(spark, directory).select("o_orderkey", F.coalesce("status", title).alias("status"))


@case("p14_drop_empty_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def p14(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_orderpriority").try_cast("double").alias("never"),
        F.lit(float("nan")).alias("not_a_number"),
    )
    return cleaning.drop_all_null_columns(orders)


@case(
    "p15_clean_nan",
    """SELECT l_partkey, count(*) AS n, count(CASE WHEN l_discount > 0 THEN 1 END) AS discounts,
    count(CASE WHEN l_tax > 0 THEN 1 END) AS taxes FROM lineitem GROUP BY 1""",
)
def p15(spark, directory) -> DataFrame:
    """NaN in a column, in an array element and in a struct field become NULL."""
    nan = F.lit(float("nan"))
    discount = F.when(F.col("l_discount") > 0, F.col("l_discount")).otherwise(nan)
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax")).otherwise(nan)
    lines = RetailStar(spark, directory).raw("lineitem").select(
        "l_partkey", F.array(discount).alias("parts"), F.struct(tax.alias("tax")).alias("inner")
    )
    return cleaning.clean_nan(lines).groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.count(F.element_at("parts", 1)).alias("discounts"), F.count("inner.tax").alias("taxes")
    )


@case(
    "p16_numeric_coercion",
    "SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS rank, "
    "TRY_CAST(o_orderpriority AS DOUBLE) AS bad, CAST(NULL AS DOUBLE) AS suffixed, CAST(NULL AS DOUBLE) AS hexed, "
    "CAST(o_orderkey AS DOUBLE) AS padded FROM orders",
)
def p16(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("orders").select(
        "o_orderkey",
        fn.to_number(F.substring_index("o_orderpriority", "-", 1)).alias("rank"),
        fn.to_number(F.col("o_orderpriority")).alias("bad"),
        fn.to_number(F.concat(F.col("o_orderkey"), F.lit("d"))).alias("suffixed"),
        fn.to_number(F.concat(F.lit("0x"), F.col("o_orderkey"), F.lit("p3"))).alias("hexed"),
        fn.to_number(F.concat(F.lit(" +"), F.col("o_orderkey"), F.lit("e0 "))).alias("padded"),
    )


@case("p17_truncate_to_integer", "SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole FROM events")
def p17(spark, directory) -> DataFrame:
    events = RetailStar(spark, directory).raw("events")
    return events.select("event_id", fn.to_key(F.col("value"), events.schema["value"].dataType).alias("whole"))


@case("p18_clip", "SELECT event_id, greatest(least(value, 50.0), 5.0) AS value FROM events")
def p18(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("events").select(
        "event_id", fn.clip(F.col("value"), low=5.0, high=50.0).alias("value")
    )


@case("p19_mask_filter", "SELECT event_id, value FROM events WHERE value > 30 AND event_type = 'view'")
def p19(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("events").filter(
        (F.col("value") > 30) & (F.col("event_type") == "view")
    ).select("event_id", "value")


@case(
    "p20_map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS label FROM orders",
)
def p20(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders")
    return cleaning.map_values(orders, "o_orderstatus", {"O": "open", "F": "filled"}, "label").select(
        "o_orderkey", "label"
    )


@case(
    "p21_first_truthy",
    "SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size % 7 ELSE p_size END AS number, "
    "CASE WHEN p_size > 25 THEN p_name ELSE p_brand END AS text FROM part",
)
def p21(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("part").select(
        "p_partkey",
        fn.first_truthy([F.col("p_size") % 7, F.col("p_size")], 0).alias("number"),
        fn.first_truthy([F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.col("p_brand")], "").alias("text"),
    )


@case(
    "p22_skip_bad_keys",
    "SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS key FROM orders WHERE o_orderstatus <> 'P'",
)
def p22(spark, directory) -> DataFrame:
    orders = RetailStar(spark, directory).raw("orders").withColumn(
        "text", F.when(F.col("o_orderstatus") == "P", "x").otherwise(F.substring("o_orderpriority", 1, 1))
    )
    key = fn.whole_key(F.col("text"), orders.schema["text"].dataType)
    return orders.select("o_orderkey", key.alias("key")).filter(F.col("key").isNotNull())


# --- scalar functions


@case(
    "f1_concat_propagates_null",
    "SELECT c_custkey, c_name || ' ' || nullif(c_mktsegment, 'MACHINERY') AS name FROM customer",
)
def f1(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("customer").select(
        "c_custkey", fn.full_name(F.col("c_name"), F.nullif("c_mktsegment", F.lit("MACHINERY"))).alias("name")
    )


@case("f2_divide", "SELECT p_partkey, p_retailprice / nullif(p_size % 5, 0) AS ratio FROM part")
def f2(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("part").select(
        "p_partkey", fn.divide(F.col("p_retailprice"), F.col("p_size") % 5).alias("ratio")
    )


@case(
    "f3_round_half_even",
    "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 8, 2) AS eighths FROM lineitem",
)
def f3(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.half_even(F.col("l_quantity") / 8).alias("eighths")
    )


@case("f4_round_four_places", "SELECT event_id, round_even(value / 7, 4) AS value FROM events")
def f4(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("events").select(
        "event_id", fn.half_even(F.col("value") / 7, 4).alias("value")
    )


@case(
    "f5_novelty_factor",
    """SELECT event_id, CAST(CASE WHEN value - 5 < 0 THEN 1.25 WHEN value - 5 = 0 THEN 1.25 WHEN value - 5 < 30 THEN 1.12
    WHEN value - 5 <= 90 THEN 1.0 ELSE 0.65 END AS DOUBLE) AS factor FROM events""",
)
def f5(spark, directory) -> DataFrame:
    minutes = fn.clip(F.col("value") - 5, low=0.0)
    return RetailStar(spark, directory).raw("events").select("event_id", fn.novelty_factor(minutes).alias("factor"))


@case(
    "f6_f7_flatten_and_join_text",
    """SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_size || ' ' || p_brand || ' ' || (p_size + 1) AS text
    FROM part""",
)
def f6(spark, directory) -> DataFrame:
    documents = RetailStar(spark, directory).catalog_documents()
    nested = fn.flat_text(F.col("Categorias_Array"), documents.schema["Categorias_Array"].dataType)
    return documents.select(
        F.col("Key").alias("p_partkey"),
        fn.join_parts([F.concat(F.col("Title"), F.lit("  ")), F.lit(" "), nested], F.col("Title")).alias("text"),
    )


@case("f8_truncate_text", "SELECT doc_id, left(text, 34) AS head FROM documents")
def f8(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("documents").select("doc_id", fn.shorten(F.col("text"), 34).alias("head"))


@case(
    "f9_format_text",
    "SELECT c_nationkey, count(*) FILTER (WHERE c_acctbal > 0) || '/' || count(*) AS covered FROM customer GROUP BY 1",
)
def f9(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("customer").groupBy("c_nationkey").agg(
        F.concat(F.count_if(F.col("c_acctbal") > 0).cast("string"), F.lit("/"), F.count("*").cast("string")).alias("covered")
    )


@case(
    "f10_guarded_ratio",
    "SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN p_retailprice / (p_size % 5) ELSE 0 END AS ratio FROM part",
)
def f10(spark, directory) -> DataFrame:
    return RetailStar(spark, directory).raw("part").select(
        "p_partkey", fn.ratio_or_zero(F.col("p_retailprice"), F.col("p_size") % 5).alias("ratio")
    )


@case("f12_dates_as_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def f12(spark, directory) -> DataFrame:
    path = new_path(spark, "event-times") + ".json"
    sinks.write_json(RetailStar(spark, directory).raw("events").select("event_id", "ts"), path)
    return readers.read_table(spark, path, "event_id BIGINT, ts STRING")

"""The star's tables read out of an order-line warehouse.

Roles: an order line is a viewing event, a payment and a subscription of the
ordering customer; parts are contents, suppliers are providers, nations and
regions are cities and countries. Each function returns the star's own layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions.scalars import date_key
from cinelake.session import spread

# Layouts of the warehouse tables, so that no file is opened to infer them.
RAW_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


class RetailStar:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.directory}/{name}.parquet")

    def geography(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            F.col("n_nationkey").cast("bigint").alias("Key"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("Country"),
        )

    def customer(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("Key"),
            F.substring_index("c_name", "#", 1).alias("First Name"),
            F.substring_index("c_name", "#", -1).alias("Last Name"),
            F.concat(F.lower("c_name"), F.lit("@mail")).alias("Email"),
            F.col("c_mktsegment").alias("Gender"),
            F.col("c_nationkey").cast("bigint").alias("Geography Key"),
            (F.col("c_acctbal") > 0).alias("Is Active"),
            F.date_format(
                F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")),
                "yyyy-MM-dd",
            ).alias("Create Date"),
        )

    def content(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("Key"),
            F.col("p_name").alias("Title"),
            (F.col("p_size") + 1970).cast("int").alias("Release Year"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("Revenue"),
        )

    def content_category(self) -> DataFrame:
        part = self.raw("part")
        by_type = part.select(F.col("p_partkey").alias("Content Key"), F.col("p_type").alias("Category Key"))
        by_brand = part.select(F.col("p_partkey").alias("Content Key"), F.col("p_brand").alias("Category Key"))
        return by_type.unionByName(by_brand)

    def category(self) -> DataFrame:
        keys = self.content_category().select(F.col("Category Key").alias("Key")).distinct()
        return keys.withColumn("Name", F.upper("Key"))

    def provider(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("Key"),
            F.col("s_name").alias("Name"),
            F.when(F.col("s_suppkey") % 3 == 0, "flatrate")
            .when(F.col("s_suppkey") % 3 == 1, "rent")
            .otherwise("premium")
            .alias("Type"),
        )

    def plan(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderpriority").alias("Key")).distinct().withColumn(
            "Type", F.substring_index("Key", "-", -1)
        )

    def _order_lines(self) -> DataFrame:
        lines, orders = spread(self.raw("lineitem"), "l_orderkey", "l_partkey"), self.raw("orders")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])

    def content_event(self) -> DataFrame:
        """Viewing events without their customer: a scan of the lines alone."""
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("Content Key"),
            F.col("l_quantity").cast("bigint").alias("Streams Count"),
            F.floor("l_extendedprice").cast("bigint").alias("Minutes Watched"),
        )

    def event(self) -> DataFrame:
        return self._order_lines().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Stream Event Key"),
            date_key(F.col("o_orderdate")).alias("Date Key"),
            F.col("o_custkey").alias("Customer Key"),
            F.col("l_partkey").alias("Content Key"),
            F.col("l_suppkey").alias("Provider Key"),
            F.col("l_quantity").cast("bigint").alias("Streams Count"),
            F.floor("l_extendedprice").cast("bigint").alias("Minutes Watched"),
            F.col("l_discount").alias("Watch Percentage"),
            (F.col("l_linestatus") == "F").alias("Completion Flag"),
        )

    def activity(self) -> DataFrame:
        """Activity dates per customer: one event per order."""
        return self.raw("orders").select(
            date_key(F.col("o_orderdate")).alias("Date Key"), F.col("o_custkey").alias("Customer Key")
        )

    def payment(self) -> DataFrame:
        return self._order_lines().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Payment Key"),
            date_key(F.col("o_orderdate")).alias("Date Key"),
            F.col("o_custkey").alias("Customer Key"),
            F.col("l_suppkey").alias("Provider Key"),
            F.col("o_orderpriority").alias("Subscription Plan Key"),
            F.col("l_extendedprice").alias("Amount"),
            F.col("l_tax").alias("Tax Amount"),
            F.col("l_discount").alias("Discount Amount"),
        )

    def subscription(self) -> DataFrame:
        return self._order_lines().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Subscription Fact Key"),
            date_key(F.col("o_orderdate")).alias("Date Key"),
            F.col("o_custkey").alias("Customer Key"),
            F.col("l_suppkey").alias("Provider Key"),
            F.col("o_orderpriority").alias("Plan Key"),
            date_key(F.col("o_orderdate")).alias("Subscription Start Date Key"),
            date_key(F.col("l_shipdate")).alias("Subscription End Date Key"),
            (F.col("l_linestatus") == "O").alias("Is Active"),
            F.col("o_totalprice").alias("Revenue"),
        )

    def availability(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("Content Key"), F.col("l_suppkey").alias("Provider Key"))
            .agg(
                F.min("l_shipdate").alias("_from"),
                F.max("l_shipdate").alias("_to"),
                F.max("l_linestatus").alias("_status"),
                F.max("l_quantity").alias("Catalog Rank Score"),
            )
            .select(
                (F.col("Content Key") * 1_000_000 + F.col("Provider Key")).alias("Catalog Key"),
                date_key(F.col("_from")).alias("Date Key"),
                "Content Key",
                "Provider Key",
                date_key(F.col("_from")).alias("License Start Date Key"),
                date_key(F.col("_to")).alias("License End Date Key"),
                (F.col("_status") == "O").alias("Is Available"),
                "Catalog Rank Score",
            )
        )

    def date(self) -> DataFrame:
        days = self.raw("orders").select(F.col("o_orderdate").cast("date").alias("_day")).distinct()
        return days.select(
            date_key(F.col("_day")).alias("Key"), F.col("_day").cast("string").alias("Date"),
            F.year("_day").alias("Year"), F.month("_day").alias("Month"), F.dayofmonth("_day").alias("Day"),
        )

    def language(self) -> DataFrame:
        used = self.raw("documents").select(F.col("lang").alias("ISO")).where("lang IS NOT NULL").distinct()
        return used.select(F.crc32("ISO").alias("Key"), F.col("ISO").alias("ID"), "ISO", F.upper("ISO").alias("Name"))

    def payment_method(self) -> DataFrame:
        kinds = self.raw("orders").select(F.col("o_orderpriority").alias("Card Type")).distinct()
        return kinds.select(F.crc32("Card Type").alias("Key"), F.crc32("Card Type").alias("Card ID"), "Card Type")

    def talent(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("Key"), F.col("s_suppkey").alias("Actor ID"),
            F.substring_index("s_name", "#", 1).alias("First Name"), F.substring_index("s_name", "#", -1).alias("Last Name"),
        )

    def content_talent(self) -> DataFrame:
        """Who takes part in which content; the character is not known for all."""
        pairs = self.raw("lineitem").select(F.col("l_partkey").alias("Content Key"), F.col("l_suppkey").alias("Talent Key"))
        role = F.when(F.col("Talent Key") % 2 == 0, F.concat(F.lit("role "), F.col("Content Key").cast("string")))
        return pairs.distinct().withColumn("Character", role)

    def viewing(self) -> DataFrame:
        """Viewing minutes of a user on a content, from the click-stream table."""
        return self.raw("events").select(
            F.col("user_id").alias("Customer Key"),
            F.get_json_object("props", "$.k").alias("Content Key"),
            F.col("value").alias("Minutes Watched"),
        )

    def documents(self) -> DataFrame:
        return spread(self.raw("documents"), "doc_id")

    def catalog_documents(self) -> DataFrame:
        """Contents with the nested fields the text recommender reads."""
        return self.raw("part").select(
            F.col("p_partkey").alias("Key"),
            F.col("p_name").alias("Title"),
            F.col("p_type").alias("Description"),
            F.array(
                F.struct(F.col("p_type").alias("Name"), F.col("p_size").alias("Rank")),
                F.struct(F.col("p_brand").alias("Name"), (F.col("p_size") + 1).alias("Rank")),
            ).alias("Categorias_Array"),
            F.split("p_name", " ").alias("Talento_Array"),
            F.lower("p_brand").alias("Name"),
            F.col("p_size").alias("Rating"),
        )

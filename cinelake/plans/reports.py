"""The five analytic reports.

Facts are aggregated before they meet a dimension, so a customer or content
that holds a large part of the rows shrinks inside the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalars import divide, full_name, half_even
from cinelake.operators.joins import Dim, drop_matching, lookup_unwind, star_join

# Report sizes.
RECENT_DATES = 30
TOP_PAIRS = 20


def total(column: str) -> Column:
    """Sum that is 0, not NULL, when a group has no value."""
    return F.coalesce(F.sum(column), F.lit(0))


def recent_dates(events: DataFrame, n: int = RECENT_DATES) -> DataFrame:
    """The last ``n`` dates that occur, which need not be consecutive days."""
    return events.select("Date Key").distinct().orderBy(F.desc("Date Key")).limit(n)


def inactive_subscribers(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Active customers without an event on the last 30 registered dates.

    The recent dates are exactly those from the 30th largest on, so the event
    scan filters on a one-value subquery, which also reaches the files.
    """
    recent_from = recent_dates(events).agg(F.min("Date Key")).scalar()
    seen = events.filter(F.col("Date Key") >= recent_from).select("Customer Key").distinct()
    return drop_matching(customers.filter(F.col("Is Active")), seen, "Key", "Customer Key")


def content_profitability(events: DataFrame, contents: DataFrame) -> DataFrame:
    per_content = events.groupBy("Content Key").agg(
        total("Streams Count").alias("Total_Streams"),
        F.count("*").alias("Total_Eventos"),
        total("Minutes Watched").alias("Total_Minutos"),
    )
    joined = lookup_unwind(
        per_content, Dim(contents, "Content Key", take={"Title": "Titulo", "Revenue": "Revenue"})
    )
    return joined.withColumn(
        "Ingreso_por_Stream", divide(F.col("Revenue"), F.col("Total_Streams"))
    ).orderBy(F.desc("Ingreso_por_Stream"), "Content Key")


def views_by_country_category(
    events: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    content_category: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """Views, events and minutes per country and category; a content in several
    categories counts in each.

    Three sums: per customer and content, then per country and content, so that
    the bridge fans out a table of countries by contents, then the result.
    """
    measures = ["Total_Visualizaciones", "Total_Eventos", "Total_Minutos"]
    resum = [total(m).alias(m) for m in measures]
    pairs = events.groupBy("Customer Key", "Content Key").agg(
        total("Streams Count").alias("Total_Visualizaciones"),
        F.count("*").alias("Total_Eventos"),
        total("Minutes Watched").alias("Total_Minutos"),
    )
    placed = lookup_unwind(
        customers.select("Key", "Geography Key"), Dim(geography, "Geography Key", take={"Country": "Pais"})
    )
    per_country = (
        lookup_unwind(pairs, Dim(placed, "Customer Key", take={"Pais": "Pais"}))
        .groupBy("Pais", "Content Key")
        .agg(*resum)
    )
    named = lookup_unwind(content_category, Dim(categories, "Category Key", take={"Name": "Categoria"}))
    return (
        lookup_unwind(per_country, Dim(named, "Content Key", "Content Key", {"Categoria": "Categoria"}))
        .groupBy("Pais", "Categoria")
        .agg(*resum)
        .orderBy(F.desc("Total_Visualizaciones"), "Pais", "Categoria")
    )


def top_customer_providers(
    events: DataFrame, customers: DataFrame, providers: DataFrame, n: int = TOP_PAIRS
) -> DataFrame:
    """The ``n`` customer and provider pairs with most events.

    Pairs are ranked by their keys alone; names are fetched for those that are left. A key
    that a dimension holds twice doubles the row, so the rows are cut once more.
    """
    pairs = events.groupBy("Customer Key", "Provider Key").agg(
        F.count("*").alias("Total_Eventos"), total("Streams Count").alias("Total_Streams")
    )
    order = [F.desc("Total_Eventos"), F.desc("Total_Streams"), "Customer Key", "Provider Key"]
    customer_keys = customers.select(F.col("Key").alias("_customer"))
    provider_keys = providers.select(F.col("Key").alias("_provider"))
    known = pairs.join(customer_keys, F.col("Customer Key").eqNullSafe(F.col("_customer")), "left_semi").join(
        provider_keys, F.col("Provider Key").eqNullSafe(F.col("_provider")), "left_semi"
    )
    named = star_join(
        known.orderBy(*order).limit(n),
        [
            Dim(customers, "Customer Key", take={"First Name": "_first", "Last Name": "_last"}),
            Dim(providers, "Provider Key", take={"Name": "Servidor"}),
        ],
    )
    return (
        named.orderBy(*order)
        .limit(n)
        .select(
            full_name(F.col("_first"), F.col("_last")).alias("Cliente"),
            "Servidor",
            "Total_Eventos",
            "Total_Streams",
        )
    )


def income_by_city(payments: DataFrame, customers: DataFrame, geography: DataFrame) -> DataFrame:
    """Payments per country and city, summed per customer first."""
    per_customer = payments.groupBy("Customer Key").agg(
        total("Amount").alias("_amount"),
        F.count("*").alias("_payments"),
        total("Tax Amount").alias("_tax"),
        total("Discount Amount").alias("_discount"),
    )
    placed = lookup_unwind(
        customers.select("Key", "Geography Key"),
        Dim(geography, "Geography Key", take={"Country": "Pais", "City": "Ciudad"}),
    )
    return (
        lookup_unwind(per_customer, Dim(placed, "Customer Key", take={"Pais": "Pais", "Ciudad": "Ciudad"}))
        .groupBy("Pais", "Ciudad")
        .agg(
            half_even(total("_amount")).alias("Ingreso_Total"),
            total("_payments").alias("Total_Pagos"),
            half_even(total("_tax")).alias("Total_Impuestos"),
            half_even(total("_discount")).alias("Total_Descuentos"),
        )
        .orderBy(F.desc("Ingreso_Total"), "Pais", "Ciudad")
    )

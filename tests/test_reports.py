from pyspark.sql import functions as F

from cinelake.operators.joins import Dim, lookup_unwind, nest_lookup
from cinelake.plans import datasets, marts, reports
from cinelake.sources import schemas



def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


CUSTOMERS = "Key BIGINT, `First Name` STRING, `Last Name` STRING, `Geography Key` BIGINT, `Is Active` BOOLEAN"
EVENTS = "`Date Key` INT, `Customer Key` BIGINT, `Content Key` BIGINT, `Provider Key` BIGINT, `Streams Count` BIGINT, `Minutes Watched` BIGINT"


def test_inactive_uses_registered_dates_not_calendar_days(spark, rows):
    # 31 distinct dates with gaps; the oldest one is not among the last 30
    dates = [20240101 + 2 * i for i in range(31)]
    events = table(
        spark,
        [(d, 1, 1, 1, 1, 1) for d in dates] + [(dates[0], 2, 1, 1, 1, 1), (dates[1], 3, 1, 1, 1, 1)],
        EVENTS,
    )
    customers = table(
        spark,
        [(1, "a", "a", 1, True), (2, "b", "b", 1, True), (3, "c", "c", 1, True), (4, "d", "d", 1, True),
         (5, "e", "e", 1, False), (6, "f", "f", 1, None)],
        CUSTOMERS,
    )
    found = reports.inactive_subscribers(customers, events)
    assert sorted(rows(found, "Key")) == [(2,), (4,)]


def test_inactive_with_fewer_dates_and_without_events(spark, rows):
    customers = table(spark, [(1, "a", "a", 1, True), (2, "b", "b", 1, True)], CUSTOMERS)
    assert rows(reports.inactive_subscribers(customers, table(spark, [(20240101, 1, 1, 1, 1, 1)], EVENTS)), "Key") == [(2,)]
    none = table(spark, [], EVENTS)
    assert sorted(rows(reports.inactive_subscribers(customers, none), "Key")) == [(1,), (2,)]


def test_missing_keys_match_each_other(spark, rows):
    fact = table(spark, [(None, 1), (1, 2), (9, 3)], "k BIGINT, v INT")
    dim = table(spark, [(None, "none"), (1, "one")], "Key BIGINT, Name STRING")
    spec = Dim(dim, "k", take={"Name": "Name"})
    assert sorted(rows(lookup_unwind(fact, spec), "v", "Name")) == [(1, "none"), (2, "one")]
    assert rows(lookup_unwind(fact, spec, null_safe=False), "v", "Name") == [(2, "one")]
    only_left = table(spark, [(1, "one")], "Key BIGINT, Name STRING")
    assert rows(lookup_unwind(fact, Dim(only_left, "k", take={"Name": "Name"})), "v") == [(2,)]


def test_profitability_zero_streams_and_big_revenue(spark, rows):
    events = table(
        spark,
        [(1, 1, 1, 1, 0, 5), (1, 1, 2, 1, 4, 5), (1, 1, 3, 1, 2, None), (1, 1, 4, 1, None, 1)],
        EVENTS,
    )
    contents = table(
        spark, [(1, "zero", 2000, 10), (2, "big", 2000, 2799439100), (3, "none", 2000, None), (4, "null", 2000, 5)], schemas.CONTENT
    )
    report = {r["Titulo"]: r for r in reports.content_profitability(events, contents).collect()}
    assert report["zero"]["Ingreso_por_Stream"] is None
    assert report["big"]["Ingreso_por_Stream"] == 2799439100 / 4
    assert report["none"]["Total_Minutos"] == 0
    assert report["null"]["Total_Streams"] == 0
    kept = rows(datasets.content_profitability(reports.content_profitability(events, contents)), "Contenido")
    assert kept == [("big",)]


def test_content_counts_once_per_category(spark, rows):
    events = table(spark, [(1, 1, 1, 1, 3, 10), (1, 1, 2, 1, 5, 20), (1, 2, 3, 1, 7, 30), (1, 1, 2, 1, 1, 1)], EVENTS)
    customers = table(spark, [(1, "a", "a", 10, True), (2, "b", "b", 10, True)], CUSTOMERS)
    geography = table(spark, [(10, "X", "Y")], "Key BIGINT, City STRING, Country STRING")
    bridge = table(spark, [(1, 100), (2, 100), (2, 200)], "`Content Key` BIGINT, `Category Key` BIGINT")
    categories = table(spark, [(100, "Drama"), (200, "Comedy")], "Key BIGINT, Name STRING")
    report = reports.views_by_country_category(events, customers, geography, bridge, categories)
    columns = ("Pais", "Categoria", "Total_Visualizaciones", "Total_Eventos", "Total_Minutos")
    assert rows(report, *columns) == [("Y", "Drama", 9, 3, 31), ("Y", "Comedy", 6, 2, 21)]


def test_same_name_pairs_stay_in_report_and_merge_in_dataset(spark, rows):
    events = table(spark, [(1, 1, 1, 7, 2, 1), (1, 2, 1, 7, 2, 1)], EVENTS)
    customers = table(
        spark, [(1, "Ana", "Paz", 1, True), (2, "Ana", "Paz", 1, True), (3, "No", None, 1, True)], CUSTOMERS
    )
    providers = table(spark, [(7, "P")], "Key BIGINT, Name STRING")
    report = reports.top_customer_providers(events, customers, providers)
    assert rows(report, "Cliente", "Total_Eventos") == [("Ana Paz", 1), ("Ana Paz", 1)]
    assert datasets.top_customer_providers(report).count() == 1


def test_top_pairs_keeps_twenty(spark):
    events = table(spark, [(1, c, 1, 7, 1, 1) for c in range(25)], EVENTS)
    customers = table(spark, [(c, f"n{c}", "x", 1, True) for c in range(25)], CUSTOMERS)
    providers = table(spark, [(7, "P")], "Key BIGINT, Name STRING")
    found = reports.top_customer_providers(events, customers, providers).collect()
    assert [r["Cliente"] for r in found] == [f"n{c} x" for c in range(20)]


def test_income_rounds_half_to_even(spark, rows):
    payments = table(
        spark,
        [(1, 0.125, 0.375, 1.0), (1, 2.0, 0.0, None), (2, 1.0, 1.0, 1.0)],
        "`Customer Key` BIGINT, Amount DOUBLE, `Tax Amount` DOUBLE, `Discount Amount` DOUBLE",
    )
    customers = table(spark, [(1, "a", "a", 10, True), (2, "b", "b", 20, True)], CUSTOMERS)
    geography = table(spark, [(10, "A", "Y"), (20, "B", "Y")], "Key BIGINT, City STRING, Country STRING")
    report = reports.income_by_city(payments, customers, geography)
    assert rows(report, "Ciudad", "Ingreso_Total", "Total_Pagos", "Total_Impuestos", "Total_Descuentos") == [
        ("A", 2.12, 2, 0.38, 1.0),
        ("B", 1.0, 1, 1.0, 1.0),
    ]


def test_customer_without_last_name_leaves_the_dataset(spark):
    availability = table(spark, [(1, 20240101, 5, 7, 20240101, 20250101, True, 1.5)] * 2, schemas.AVAILABILITY)
    contents = table(spark, [(5, "T", 1999, 1)], schemas.CONTENT)
    providers = table(spark, [(7, 7, "P", "rent", "US")], schemas.PROVIDER)
    mart = marts.availability_mart(availability, contents, providers)
    assert mart.count() == 2 and datasets.mart(mart).count() == 1
    subscriptions = table(
        spark,
        [(1, 20240101, 1, 7, 46, 20240101, 20240201, True, 9.99), (2, 20240101, 2, 7, 46, 20240101, 20240201, True, 9.99)],
        schemas.SUBSCRIPTION,
    )
    customers = table(spark, [(1, "a", "b", 10, True), (2, "a", None, 10, True)], CUSTOMERS)
    plans = table(spark, [(46, "flatrate", 1.0, 1, "HD")], schemas.PLAN)
    report = marts.subscription_mart(subscriptions, customers, providers, plans)
    assert report.count() == 2
    assert [r["Suscripcion_ID"] for r in datasets.mart(report).collect()] == [1]


def test_empty_facts_keep_their_columns(spark):
    customers = table(spark, [(1, "a", "b", 10, True)], CUSTOMERS)
    geography = table(spark, [(10, "A", "Y")], "Key BIGINT, City STRING, Country STRING")
    providers = table(spark, [(7, 7, "P", "rent", "US")], schemas.PROVIDER)
    plans = table(spark, [(46, "flatrate", 1.0, 1, "HD")], schemas.PLAN)
    contents = table(spark, [(5, "T", 1999, 1)], schemas.CONTENT)
    payments = table(spark, [], schemas.PAYMENT)
    for df, width in (
        (marts.payment_mart(payments, customers, geography, providers, plans), 10),
        (marts.streaming_mart(table(spark, [], schemas.EVENT), customers, geography, contents, providers), 11),
        (marts.availability_mart(table(spark, [], schemas.AVAILABILITY), contents, providers), 10),
        (datasets.income_by_city(reports.income_by_city(payments, customers, geography)), 6),
    ):
        assert df.count() == 0 and len(df.columns) == width


def test_nested_lookup_keeps_unmatched(spark, rows):
    left = table(spark, [(1,), (2,), (None,)], "k BIGINT")
    right = table(spark, [(1, "a"), (1, "b"), (None, "n")], "r BIGINT, v STRING")
    nested = nest_lookup(left, right, "k", "r", "found")
    got = {r["k"]: [x["v"] for x in r["found"]] for r in nested.collect()}
    assert got == {1: ["a", "b"], 2: [], None: ["n"]}


def test_a_hot_customer_is_combined_before_the_join(spark):
    """The report's plan aggregates below its first join."""
    events = table(spark, [(1, 1, 1, 7, 2, 1)], EVENTS)
    customers = table(spark, [(1, "Ana", "Paz", 1, True)], CUSTOMERS)
    providers = table(spark, [(7, "P")], "Key BIGINT, Name STRING")
    report = reports.top_customer_providers(events, customers, providers)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
    assert report.agg(F.sum("Total_Eventos")).first()[0] == 1

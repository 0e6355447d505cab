"""Every query over a small stored star, read from files and from session tables."""

import json

import pytest

from cinelake.plans import registry
from cinelake.sources import schemas
from cinelake.sources.stored_star import StoredStar

TABLES = {
    "customer": [(k, f"n{k}", f"s{k}", f"{k}@mail", "F", None, 1 + k % 2, True, "2024-01-01") for k in range(1, 7)],
    "content": [(k, f"Title {k}", 2000 + k, 1000 * k) for k in range(1, 5)],
    "geography": [(1, 1, None, None, "Nice", "France", "fr", "06000"), (2, 2, None, None, "Cork", "Ireland", "ie", "T12")],
    "category": [(10, 1, "Drama"), (11, 2, "Comedy")],
    "content_category": [(1, 10), (2, 10), (2, 11), (3, 11), (4, 10)],
    "provider": [(7, 1, "One", "rent", "US"), (8, 2, "Two", "premium", "US")],
    "plan": [(46, "flatrate", 9.99, 2, "HD")],
    "event": [(n, 20240101 + n % 28, 1 + n % 5, 1 + n % 4, 7 + n % 2, n % 3 + 1, 10 * n % 100, 0.5, True) for n in range(60)],
    "payment": [(n, 20240101, 1 + n, 7, 46, 9.99, 1.5, 0.0) for n in range(5)],
    "subscription": [(n, 20240101, 1 + n, 8, 46, 20240101, 20240201, True, 9.99) for n in range(5)],
    "availability": [(n, 20240101, 1 + n % 4, 7, 20240101, 20250101, True, 1.0 + n) for n in range(8)],
}


@pytest.fixture(scope="module")
def directory(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("star")
    for role, rows in TABLES.items():
        df = spark.createDataFrame(rows, schemas.SCHEMAS[role])
        name = schemas.TABLE_NAMES[role][-1]
        if role in ("event", "payment"):
            df.write.parquet(str(path / f"{name}.parquet"))
        else:
            (path / f"{name}.json").write_text(json.dumps([json.loads(j) for j in df.toJSON().collect()]))
    (path / "catalog.json").write_text(
        json.dumps([{"Key": k, "Title": f"Title {k}", "Categorias_Array": [{"Name": "Drama"}]} for k in range(1, 4)])
    )
    return str(path)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_and_dataset(spark, directory, name):
    star = StoredStar(spark, directory)
    report, dataset = registry.QUERIES[name](star), registry.dataset(name, star)
    assert report.count() >= dataset.count() > 0


@pytest.mark.parametrize("name", list(registry.MODELS))
def test_model(spark, directory, name):
    expected = {"method_comparison": 3}.get(name, 5)
    assert registry.MODELS[name](StoredStar(spark, directory)).count() == expected


def test_inactive_customer_is_the_one_without_events(spark, directory):
    got = registry.dataset("inactive_subscribers", StoredStar(spark, directory)).collect()
    assert [r["Cliente_ID"] for r in got] == [6]


def test_totals_reconcile(spark, directory):
    star = StoredStar(spark, directory)
    profit = registry.dataset("content_profitability", star).groupBy().sum("Total_Reproducciones").first()[0]
    segments = registry.MODELS["user_segments"](star).groupBy().sum("total_eventos").first()[0]
    assert profit == segments == sum(e[5] for e in TABLES["event"])
    cities = registry.dataset("income_by_city", star).groupBy().sum("Ingreso_Total_Suscriptores").first()[0]
    payments = registry.dataset("payment_mart", star).groupBy().sum("Monto").first()[0]
    assert cities == pytest.approx(payments)


def test_session_tables(spark):
    spark.createDataFrame(TABLES["provider"], schemas.PROVIDER).createOrReplaceTempView("proveedor")
    assert StoredStar(spark).provider().count() == 2


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(LookupError, match="DimCustomer"):
        StoredStar(spark, str(tmp_path)).customer()


def test_generate_datasets_reports_what_is_missing(spark, directory, tmp_path):
    class Partial(StoredStar):
        def payment(self):
            raise LookupError("no payments")

    report = registry.generate_datasets(Partial(spark, directory), str(tmp_path)).collect()
    status = {r["Target"]: r["Status"] for r in report}
    assert [n for n, s in status.items() if s == "failed"] == ["income_by_city", "payment_mart"]
    assert list(status.values()).count("written") == 7

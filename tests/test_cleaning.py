import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions import scalars as fn
from cinelake.functions.text import with_bigrams, word_tokens
from cinelake.operators import catalog, cleaning
from cinelake.operators.matrix import normalize_events
from cinelake.sources import readers, sinks
from cinelake.sources.schemas import TABLE_NAMES


def test_dirty_events(spark, rows):
    events = spark.createDataFrame(
        [("1", "10", "5.5"), ("2", "10", "-3"), ("3.9", "11", "7"), (None, "1", "1"), ("4", "x", "1"),
         ("5", "1", "NaN"), ("6", "1", "abc"), ("9007199254740993", "1", "2")],
        "customerKey STRING, content_key STRING, `Minutes Watched` STRING",
    )
    assert sorted(rows(normalize_events(events))) == [
        (1, 10, 5.5), (2, 10, 0.0), (3, 11, 7.0), (9007199254740993, 1, 2.0)
    ]


def test_missing_event_columns_are_named(spark):
    with pytest.raises(ValueError, match="Content_Key, Minutes_Watched"):
        normalize_events(spark.createDataFrame([(1,)], "customer_key BIGINT"))


def test_empty_columns_and_nan_inside_arrays(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, None, nan, [1.0, nan], (nan, "a")), (2, None, nan, None, None)],
        "a INT, b STRING, c DOUBLE, d ARRAY<DOUBLE>, e STRUCT<x: DOUBLE, y: STRING>",
    )
    kept = cleaning.clean_nan(cleaning.drop_all_null_columns(df))
    assert kept.columns == ["a", "d", "e"]
    first, second = kept.orderBy("a").collect()
    assert first["d"] == [1.0, None] and first["e"]["x"] is None and first["e"]["y"] == "a"
    assert second["d"] is None and second["e"] is None


def test_dropna_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x DOUBLE, y STRING")
    assert cleaning.finish(df).collect() == [(1.0, "a")]


def test_json_leaves_missing_fields_out_and_keeps_accents(spark, tmp_path):
    df = spark.createDataFrame([(1, "Île", None, float("nan"))], "k INT, city STRING, gone STRING, bad DOUBLE")
    sinks.write_json(df, str(tmp_path / "t"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()] == ['{"k":1,"city":"Île"}']


def test_json_array_table(spark, tmp_path):
    path = tmp_path / "plan.json"
    path.write_text('[\n  {"Key": 46, "Type": "flatrate", "Monthly Fee": 9.99},\n  {"Key": 47, "Type": "rent"}\n]')
    df = readers.read_json_array(spark, str(path), "Key BIGINT, Type STRING, `Monthly Fee` DOUBLE")
    assert sorted(tuple(r) for r in df.collect()) == [(46, "flatrate", 9.99), (47, "rent", None)]


def test_first_available_falls_back_and_ends_empty(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b.parquet"))
    paths = [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")]
    assert readers.read_first_available(spark, paths, "id BIGINT").count() == 3
    empty = readers.read_first_available(spark, paths[:1], "id BIGINT")
    assert empty.count() == 0 and empty.columns == ["id"]


def test_resolve_table_prefers_the_first_name(spark):
    spark.range(2).createOrReplaceTempView("clientes")
    spark.range(5).createOrReplaceTempView("customer")
    assert readers.resolve_table(spark, ["clientes", "customer"]).count() == 2
    assert readers.resolve_table(spark, TABLE_NAMES["customer"]).count() == 2
    with pytest.raises(LookupError):
        readers.resolve_table(spark, ["no_such_table"])


def test_require_rows(spark):
    with pytest.raises(RuntimeError):
        readers.require_rows(spark.range(0), "events")


def test_exports_report_failures_and_go_on(spark, tmp_path):
    def broken():
        raise ValueError("no data today")

    report = sinks.export_datasets(spark, {"bad": broken, "good": lambda: spark.range(4)}, str(tmp_path))
    assert [tuple(r) for r in report.collect()] == [("bad", "failed", 0, "no data today"), ("good", "written", 4, None)]


def test_export_skips_empty_tables(spark, tmp_path):
    report = sinks.export_tables(spark, {"none": spark.range(0), "some": spark.range(2)}, str(tmp_path))
    assert {r["Target"]: (r["Status"], r["Rows"]) for r in report.collect()} == {"none": ("skipped", 0), "some": ("written", 2)}


def test_novelty_edges(spark):
    df = spark.createDataFrame([(0.0,), (29.9,), (30.0,), (90.0,), (90.1,)], "m DOUBLE")
    assert [r[0] for r in df.select(fn.novelty_factor(F.col("m"))).collect()] == [1.25, 1.12, 1.0, 1.0, 0.65]


def test_numbers(spark):
    df = spark.createDataFrame([(None, -1.0), (5.0, 2.0), (0.125, 0.375)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(fn.clip(F.col("a"), 0.0, 1.0)).collect()] == [None, 1.0, 0.125]
    assert [r[0] for r in df.select(fn.half_even(F.col("a"))).collect()] == [None, 5.0, 0.12]
    assert [r[0] for r in df.select(fn.ratio_or_zero(F.col("a"), F.col("b"))).collect()][0] == 0.0
    assert df.select(fn.divide(F.col("a"), F.lit(0))).first()[0] is None


def test_full_name_is_null_without_a_part(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x STRING, y STRING")
    assert [r[0] for r in df.select(fn.full_name(F.col("x"), F.col("y"))).collect()] == [None, "a b"]


def test_first_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "z"), (1, 2, "b")], "k INT, o INT, v STRING")
    assert sorted(rows(cleaning.first_by_key(df, "k", [F.col("o")]), "k", "v")) == [(1, "a"), (2, "z")]


def test_tokens_keep_accents_drop_stop_words_and_single_letters(spark):
    df = spark.createDataFrame([("El niño and the LÉO x_1 a b", ), (None,)], "t STRING")
    tokens = [r[0] for r in df.select(word_tokens(F.col("t"))).collect()]
    assert tokens == [["el", "niño", "léo", "x_1"], []]
    pairs = df.select(with_bigrams(word_tokens(F.col("t")))).first()[0]
    assert pairs == ["el", "niño", "léo", "x_1", "el niño", "niño léo", "léo x_1"]


CATALOG = (
    "n INT, Key STRING, `Content Key` STRING, Title STRING, Description STRING, "
    "Categorias_Array ARRAY<STRUCT<Name: STRING, Rank: INT, Inner: STRUCT<z: STRING>>>, "
    "Talento_Array ARRAY<ARRAY<STRING>>, Name STRING, Rating DOUBLE"
)


def test_catalog_texts(spark):
    documents = spark.createDataFrame(
        [
            (1, "5", None, "First", " text ", [("Drama", 1, ("hidden",)), (None, None, None)], [["A", ""], ["B"]], "en", 7.5),
            (2, "5", None, "Second", None, None, None, None, None),
            (3, "abc", "6", "Bad key", None, None, None, None, None),
            (4, None, "7", "", "", None, None, None, None),
            (5, "", "8", "Other key", None, [], [], "  ", None),
            (6, None, None, "No key", None, None, None, None, None),
        ],
        CATALOG,
    )
    # the last key field is absent, so rows depend on the first two
    got = {r["Content_Key"]: (r["Titulo"], r["Texto"]) for r in catalog.build_catalog(documents, [F.col("n")]).collect()}
    assert got == {
        5: ("First", "First text Drama 1 A B en 7.5"),
        7: ("Content 7", "Content 7"),
        8: ("Other key", "Other key"),
    }


def test_zero_key_falls_through(spark):
    documents = spark.createDataFrame(
        [(0, 3, "a"), (0, 0, "b"), (4, 9, "c")], "Key BIGINT, Content_Key BIGINT, Title STRING"
    )
    got = {r["Content_Key"]: r["Titulo"] for r in catalog.build_catalog(documents).collect()}
    assert got == {3: "a", 0: "b", 4: "c"}


def test_alignment_keeps_watched_contents_only(spark):
    items = spark.createDataFrame([(1,), (1,), (2,)], "Content_Key BIGINT")
    known = spark.createDataFrame([(1, "One", "one text"), (3, "Three", "three")], "Content_Key BIGINT, Titulo STRING, Texto STRING")
    got = {r[0]: (r[1], r[2]) for r in catalog.align_catalog(items, known).collect()}
    assert got == {1: ("One", "one text"), 2: ("Content 2", "content 2")}
    assert {r[0] for r in catalog.complete_catalog(items, known).collect()} == {1, 2, 3}


@pytest.mark.parametrize(
    "text,number",
    [("12", 12.0), (" +1.5e2 ", 150.0), (".5", 0.5), ("12d", None), ("3f", None), ("1.D", None), ("0x1p3", None), ("x", None), (None, None)],
)
def test_only_plain_numbers_are_read(spark, rows, text, number):
    df = spark.createDataFrame([(text,)], "v STRING")
    assert rows(df.select(fn.to_number(F.col("v")))) == [(number,)]


def test_scalars_are_spelled_without_short_exponents(spark, rows):
    values = [12345678.0, 1.5, 0.0, 0.00012, 0.000015, 1e16, 2.5e20, -98765432.25, float("nan"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = [r[0] for r in rows(df.select(fn.flat_text(F.col("v"), T.DoubleType())))]
    assert got == [str(v) if v is not None else "" for v in values]
    flags = spark.createDataFrame([(True,), (False,)], "v BOOLEAN")
    assert rows(flags.select(fn.flat_text(F.col("v"), T.BooleanType()))) == [("True",), ("False",)]

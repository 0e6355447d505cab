from pyspark.sql import functions as F

from cinelake.operators.joins import lookup_summary, nest_lookup
from cinelake.sources.readers import read_csv_lines, read_first_available, read_table
from cinelake.sources.sinks import export_datasets, export_tables, write_csv, write_csv_lines, write_json
from cinelake.sources.stored_star import StoredStar


def test_csv_round_trip_of_ordinary_text(spark, tmp_path):
    rows = [(1, 'a "quoted" word'), (2, "two\nlines, and a comma"), (3, " edges "), (4, None), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "k int, text string")
    write_csv(df, str(tmp_path / "t.csv"))
    back = read_table(spark, str(tmp_path / "t.csv"), df.schema)
    assert sorted(tuple(r) for r in back.collect()) == rows
    report = export_datasets(spark, {"t": lambda: df}, str(tmp_path)).first()
    assert (report.Status, report.Rows) == ("written", 5)


def test_own_json_export_is_read_whole(spark, tmp_path):
    df = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "Category_Key int, Name string").coalesce(1)
    from cinelake.sources.schemas import TABLE_NAMES

    write_json(df, str(tmp_path / f"{TABLE_NAMES['category'][0]}.json"))
    assert StoredStar(spark, str(tmp_path)).category().count() == 5


TEXTS = ["plain", "", None, "two\nlines\r\n", "back\\slash", "\\n", "\\\\n", "\\\n", "\\", "\\\\", 'a "quoted", word', " edges ", "é\n", "\\r\r"]


def test_empty_text_is_not_missing(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")
    assert write_csv(df, str(tmp_path / "t.csv")) == len(TEXTS)
    back = read_table(spark, str(tmp_path / "t.csv"), df.schema)
    got = {r.k: r.text for r in back.collect()}
    assert got[1] == "" and got[2] is None and got[4] == "back\\slash"


def test_csv_of_one_line_per_record(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)) * 50, "k int, text string").coalesce(1)
    assert write_csv_lines(df, str(tmp_path / "t.csv")) == 50 * len(TEXTS)
    assert spark.read.text(str(tmp_path / "t.csv")).count() == 50 * len(TEXTS) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        back = read_csv_lines(spark, str(tmp_path / "t.csv"), df.schema)
        assert back.rdd.getNumPartitions() > 3  # one file, several tasks
        assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, list(enumerate(TEXTS)) * 50))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fallback_past_missing_empty_and_damaged_files(spark, tmp_path):
    schema = "k bigint, name string"
    full = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    full.limit(0).write.parquet(str(tmp_path / "empty.parquet"))
    (tmp_path / "damaged.parquet").write_bytes(b"PAR1 this is no table PAR1")
    full.select("k").write.parquet(str(tmp_path / "narrow.parquet"))
    full.write.parquet(str(tmp_path / "full.parquet"))
    paths = [str(tmp_path / f"{n}.parquet") for n in ("none", "empty", "damaged", "narrow", "full")]
    assert sorted(map(tuple, read_first_available(spark, paths, schema).collect())) == [(1, "a"), (2, "b")]
    nothing = read_first_available(spark, paths[:4], schema)
    assert nothing.columns == ["k", "name"] and nothing.count() == 0


def test_exports_compute_each_table_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = spark.range(30).selectExpr("id", "CAST(NULL AS STRING) AS nothing", "double('NaN') AS nan").mapInArrow(
        seen, "id bigint, nothing string, nan double"
    )
    report = {r.Target: (r.Status, r.Rows) for r in export_tables(spark, {"t": df, "none": df.where("id < 0")}, str(tmp_path)).collect()}
    assert report == {"t": ("written", 30), "none": ("skipped", 0)} and runs.value == 60  # one pass for each of both
    assert spark.read.json(str(tmp_path / "t")).columns == ["id"] and not (tmp_path / "none").exists()
    assert export_datasets(spark, {"t": lambda: df}, str(tmp_path)).first().Rows == 30 and runs.value == 90


def test_a_key_with_many_matches(spark):
    left = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k int")
    right = spark.range(20_000).selectExpr("CAST(1 AS INT) AS k", "id AS v").unionByName(
        spark.createDataFrame([(None, 5), (3, None)], "k int, v bigint")
    )
    measures = {"n": F.count("*"), "odd": F.count_if(F.col("v") % 2 == 1), "first": F.min("v")}
    out = lookup_summary(left, right, "k", "k", measures, {"n": F.lit(0), "odd": F.lit(0)})
    assert {r.k: (r.n, r.odd, r.first) for r in out.collect()} == {
        1: (20_000, 10_000, 0), 2: (0, 0, None), None: (1, 1, 5), 3: (1, 0, None),
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "collect_list" not in plan
    assert nest_lookup(left, right, "k", "k", "m").selectExpr("max(size(m))").first()[0] == 20_000


def _files(folder):
    return [p for p in folder.rglob("*") if p.is_file() and p.name.startswith("part-")]


def test_exported_tables_are_compressed_and_leave_no_shuffle(spark, tmp_path):
    dropped, before = [], spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")

    def seen():
        dropped.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return spark.range(3)

    df = spark.range(5000).selectExpr("id AS `Long Name Of A Key`", "'the same text' AS `Long Name Of A Text`")
    report = export_tables(spark, {"t": df}, str(tmp_path / "out")).first()
    assert (report.Status, report.Rows) == ("written", 5000)
    files = _files(tmp_path / "out" / "t")
    assert all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) * 4 < len('{"Long Name Of A Key":1000,"Long Name Of A Text":"the same text"}\n') * 5000
    back = spark.read.json(str(tmp_path / "out" / "t"))
    assert sorted(map(tuple, back.collect())) == [(n, "the same text") for n in range(5000)]
    export_datasets(spark, {"x": seen}, str(tmp_path / "out"))
    assert dropped == ["true"] and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_exported_datasets_are_compressed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,\nb"), (2, ""), (3, None)], "k int, text string").dropDuplicates()
    assert export_datasets(spark, {"t": lambda: df}, str(tmp_path)).first().Rows == 3
    assert all(f.name.endswith(".csv.gz") for f in _files(tmp_path / "t"))
    export_datasets(spark, {"t.csv": lambda: df}, str(tmp_path))
    back = {r.k: r.text for r in read_table(spark, str(tmp_path / "t.csv"), df.schema).collect()}
    assert back == {1: "a,\nb", 2: "", 3: None}

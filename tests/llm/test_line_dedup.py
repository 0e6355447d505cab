import random

import pytest
from pyspark.sql import functions as F

from cinelake.llm import line_dedup


def distance(a, b):
    if a[:1000] == b[:1000]:  # very long ones
        a, b = a[1000:], b[1000:]
        if a.startswith(b) or b.startswith(a):
            return abs(len(a) - len(b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def changed(text, rng, letters):
    chars = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randint(0, len(chars))
        kind = rng.randint(0, 2)
        if kind == 0:
            chars.insert(at, rng.choice(letters))
        elif chars and at < len(chars):
            if kind == 1:
                chars[at] = rng.choice(letters)
            else:
                del chars[at]
    return "".join(chars)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("ab", "ab"), ("abcd", "abdc")]
    for _ in range(400):
        a = "".join(rng.choice("abé日") for _ in range(rng.randint(0, 14)))
        pairs.append((a, changed(a, rng, "abé日")))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", line_dedup.edit_distance_within("a", "b", edits).alias("near")).collect()
    assert [r.near for r in got] == [distance(r.a, r.b) <= edits for r in got]


def brute(rows, edits, min_chars):
    """Rows of (id, text); ids are distinct or NULL."""
    first, out = {}, {}
    lines = [
        ((doc_id is not None, doc_id, number), line)
        for doc_id, text in rows
        for number, line in enumerate((text or "").split("\n"))
        if text is not None and len(line) >= min_chars
    ]
    for place, line in lines:
        first[line] = min(first.get(line, place), place)
    for place, line in lines:
        near = any(
            other < first[line] and abs(len(x) - len(line)) <= edits and distance(x, line) <= edits
            for x, other in first.items() if x != line
        )
        if near or place != first[line]:
            out.setdefault(place[1], []).append(place[2])
    return {k: sorted(v) for k, v in out.items()}


def test_against_brute_force(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcde ñ") for _ in range(rng.randint(18, 40))) for _ in range(25)]
    rows = []
    for doc_id in range(40):
        lines = [changed(rng.choice(pool), rng, "abcdeñ") for _ in range(rng.randint(0, 6))] + ["short"] * rng.randint(0, 2)
        rows.append((doc_id, "\n".join(lines)))
    rows += [(None, pool[0] + "\n" + pool[1]), (90, None), (91, ""), (92, "\n\n"), (93, "x" * 30_000), (94, "x" * 30_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.report(df).collect()}
    expected = brute(rows, 2, 20)
    assert len(got) == len(rows)
    assert {k: r.dropped for k, r in got.items() if r.dropped} == expected
    assert got[90].n_lines == 0 and got[92].n_lines == 3 and got[94].dropped == [0]


def test_cut_texts_repeated_rows_and_clashing_names(spark):
    long_, other = "a line that is long enough", "another line, long enough too"
    rows = [
        (1, f"{long_}\n{other}", 1, 2, "k"), (1, f"{long_}\n{other}", 1, 2, "k"),
        (2, long_, 3, 4, "k"), (3, f"{long_}!\nnew and also long enough\nhi", 5, 6, "k"), (4, None, 7, 8, None), (5, "", 9, 9, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, at long, id long, dropped string")
    out = sorted(tuple(r) for r in line_dedup.without_duplicate_lines(df).collect() if r.text)
    assert out == [
        (1, f"{long_}\n{other}", 1, 2, "k"), (1, f"{long_}\n{other}", 1, 2, "k"),
        (3, "new and also long enough\nhi", 5, 6, "k"),
    ]
    assert line_dedup.without_duplicate_lines(df).columns == df.columns
    assert line_dedup.without_duplicate_lines(df).where("doc_id IN (4, 5)").count() == 2
    assert line_dedup.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_pass_the_counts_and_share_a_key(spark, edits):
    rng = random.Random(10 + edits)
    pairs = []  # the longer line first: it probes the segments of the other
    while len(pairs) < 300:
        a = "".join(rng.choice("eanirtsoludchmpgbv0é日 ") for _ in range(rng.choice([20, 21, 22, 40, 90, 200])))
        b = changed(a, rng, "eagbv0é日")
        if distance(a, b) <= edits:
            pairs.append((a, b) if len(a) >= len(b) else (b, a))
    df = spark.createDataFrame(pairs, "a string, b string")

    def keys(name):
        wide = F.encode(name, "UTF-32")
        return F.array(*line_dedup._probe_keys(wide, F.char_length(name), edits))

    counts = [line_dedup._LETTERS, line_dedup._OTHERS]
    near = [line_dedup._may_be_near(line_dedup._letters(F.col("a"), c), line_dedup._letters(F.col("b"), c), edits) for c in counts]
    met = F.arrays_overlap(keys("a"), F.slice(keys("b"), 1, edits + 1))
    assert all(all(r) for r in df.select(*near, met).collect())


def test_keys_of_own_segments_and_texts_are_hashed_once(spark):
    """Twelve keys a line for two edits, and the text's hash below the lines, not once for each of them."""
    assert len(line_dedup._probe_keys(F.col("wide"), F.col("length"), 2)) == 12
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup._lines(df, "doc_id").select("id", "at", "line")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("xxhash64(text")


def test_lines_are_filtered_before_they_are_shuffled(spark):
    """Also where the keys are too many to be broadcast: only what passes the filter of fixed size moves."""
    lines = spark.range(50).selectExpr("id AS h", "id AS g", "'x' AS line")
    keys = spark.range(7).selectExpr("id AS h")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = line_dedup._among(lines, keys, line_dedup._filter(keys))
        assert sorted(r.h for r in found.collect()) == list(range(7))
        plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [line for line in plan if "Join " in line]
        assert len(joins) == 2 and "h#" in joins[0] and "word#" in joins[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

from collections import Counter, defaultdict

from cinelake.llm import sharding


def check(rows, placed, shards):
    assert len(placed) == len(rows)
    counts = Counter(r.shard for r in placed)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_even_and_together(spark):
    rows = [(i, f"group {i % 7}") for i in range(70)] + [(100 + i, f"alone {i}") for i in range(150)]
    rows += [(None, None), (None, ""), (300, ""), (301, None), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(df, shards=5)
    placed = out.collect()
    check(rows, placed, 5)
    where = defaultdict(Counter)
    for r in placed:
        if r.link and r.doc_id is not None and r.doc_id < 70:
            where[r.link][r.shard] += 1
    assert sum(max(c.values()) for c in where.values()) >= 60  # random places would give about 25
    assert sharding.cut_links(out) < 7 * 45 / 2


def test_group_larger_than_a_shard(spark):
    rows = [(i, "same") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, row int, link int".split(", shard")[0])
    placed = sharding.shard_documents(df, shards=6).collect()
    check(rows, placed, 6)
    same = Counter(r.shard for r in placed if r.doc_id < 400)
    assert sum(sorted(same.values())[-5:]) >= 360


def test_everything_linked_and_few_rows(spark):
    rows = [(i, f"pair {i // 2}") for i in range(48)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, sharding.shard_documents(df, shards=4).collect(), 4)
    check(rows[:3], sharding.shard_documents(df.limit(3), shards=8).collect(), 8)
    assert sharding.shard_documents(df.limit(0)).count() == 0

import random

import pytest

from cinelake.llm import near_duplicates as nd


def brute(rows, width, share):
    sets = {}
    for doc_id, text in rows:
        w = (text or "").lower().split()
        n = min(width, len(w))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and share[1] * common >= share[0] * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("small, tile", [(48, 4096), (2, 4096), (2, 3)])
def test_against_brute_force(spark, monkeypatch, small, tile):
    monkeypatch.setattr(nd, "SMALL", small)  # with 2, stars and tiles have to find the links
    monkeypatch.setattr(nd, "TILE", tile)
    rng = random.Random(small + tile)
    word = lambda: "w%d" % rng.randint(0, 3000)
    rows, number = [(1000, None), (1001, ""), (1002, "one"), (1003, "One"), (1004, "one two"), (1005, "x " * 20_000)], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 90))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            rows.append((number, " ".join(text)))
            number += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, width=3, share=(85, 100)).collect()}
    assert got == brute(rows, 3, (85, 100))


def test_empty_table(spark):
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_dense_group_of_chained_copies(spark, monkeypatch):
    """Copies of one text that link only by way of a few of them, beside texts that share a long passage."""
    monkeypatch.setattr(nd, "SMALL", 8)
    monkeypatch.setattr(nd, "TILE", 40)
    rng = random.Random(7)
    word = lambda: "w%d" % rng.randint(0, 30_000)
    base, passage = [word() for _ in range(120)], [word() for _ in range(80)]
    rows = []
    for number in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = word()
        rows.append((number, " ".join(text)))
        rows.append((1000 + number, " ".join(passage + [word() for _ in range(rng.randint(5, 60))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, width=3, share=(85, 100)).collect()}
    assert got == brute(rows, 3, (85, 100))


def test_rows_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Copies of one text that are pairwise a little below the threshold, some of them linked."""
    monkeypatch.setattr(nd, "SMALL", 8)
    stored = {}

    def counted(df, label="stage"):
        table = plain(df, label)
        stored[label] = max(stored.get(label, 0), table.count())
        return table

    plain = nd.materialize
    monkeypatch.setattr(nd, "materialize", counted)
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randint(0, 300_000)
    base, rows, count = [word() for _ in range(600)], [], 150
    for number in range(count):
        text = list(base)
        for at in rng.sample(range(0, 600, 3), 11):
            text[at] = word()
        rows.append((number, " ".join(text)))
        if number % 10 == 0:
            rows.append((1000 + number, " ".join([*text[:-1], "other"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, width=3, share=(85, 100)).collect()}
    assert got == brute(rows, 3, (85, 100))
    # every tree holds every text about once; all pairs would be 13,530
    assert max(stored.values()) <= 2 * nd.TREES * len(rows), stored


def test_long_strangers_make_smaller_tiles(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 2)
    monkeypatch.setattr(nd, "TILE", 1)  # a block for each 1024 shingles of strangers
    base = [f"w{n}" for n in range(1500)]
    rows = [(n, " ".join(base[: 1500 - 40 * n])) for n in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, width=3, share=(85, 100)).collect()}
    assert got == brute(rows, 3, (85, 100))


def test_bytes_agree_as_sets_do():
    rng = random.Random(3)
    for size, common in ((400, 380), (60, 56), (2000, 1900)):
        values = [rng.getrandbits(64) for _ in range(2 * size - common)]
        one, two = (nd.np.array(sorted(v), nd.np.uint64) for v in (values[:size], values[size - common :]))
        far = nd.np.array(sorted(rng.getrandbits(64) for _ in range(size)), nd.np.uint64)
        others = nd.np.stack([nd.bytes_of(two), nd.bytes_of(far)])
        assert nd.alike(nd.bytes_of(one), others, 0.85).tolist() == [0]

import math
import random
import re
from collections import Counter

import pytest

from cinelake.llm import lexical

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, top=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -s) for rank, (s, _, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def some(count, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "é", "Éa", "x1", "ONE", "ß"] + [f"w{n}" for n in range(60)]
    text = lambda most: rng.choice([" ", "-", "\n", "_"]).join(
        rng.choices(vocabulary, [1 / (1 + k) for k in range(len(vocabulary))], k=rng.randint(0, most))
    )
    docs = [(n, text(rng.choice([3, 30, 300]))) for n in range(count)]
    docs += [(count + n, docs[5][1]) for n in range(40)]  # copies: ties
    docs += [(1000, None), (1001, ""), (1002, "--- !!"), (None, docs[6][1]), (1003, "w1 " * 5000 + "w2 rare")]
    items = [(f"i{n}", text(12)) for n in range(25)]
    items += [("none", None), ("empty", ""), ("unseen", "qqq"), ("one", "rare"), ("ties", docs[5][1]), (None, "w3 W3 w4"), ("one", "rare")]
    return docs, items


@pytest.mark.parametrize("bucket, focus, parts", [(2048, 16, 1 << 22), (16, 2, 1 << 22), (64, 16, 400)])
def test_against_all_documents(spark, monkeypatch, bucket, focus, parts):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "FOCUS", focus)
    docs, items = some(300, bucket)
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, rank int").repartition(5)
    right = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, id int")
    got = lexical.search(left, right, part_bytes=parts).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)


def test_long_texts_are_split_between_terms(spark, monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 16)
    docs, items = some(60, 3)
    docs.append((2000, "averylongtermwithoutanygapthatislongerthanapiece é" * 9 + " w7"))
    items.append(("long", "averylongtermwithoutanygapthatislongerthanapiece"))
    for text in (t for _, t in docs if t):
        raw = text.encode()
        pieces = list(lexical._pieces(raw))
        assert b"".join(pieces) == raw and [w for p in pieces for w in lexical.words_of(p)] == lexical.words_of(raw)
    queries = lexical.Queries([(i, t and t.encode()) for i, t in items])
    assert len(queries.names) == len(items)


def test_buckets_are_skipped():
    queries = lexical.Queries([("a", b"x y z")])
    weights = lexical.np.array([9, 5, 2])
    np = lexical.np
    near = lexical._Bucket([1], np.array([3e6]), np.array([0, 3]), np.array([0, 1, 2], np.int32), np.array([9 * 10**5] * 3, np.int32))
    far = lexical._Bucket([2, 3], np.array([9.0, 8.0]), np.array([0, 1, 2]), np.array([2, 2], np.int32), np.array([4, 3], np.int32))
    search = lexical.Search(queries, weights, np.zeros(1, np.int64), 1)
    assert search.add(near) == 1 and search.add(far) == 0
    assert list(search.found()) == [(0, 1, 16 * 9 * 10**5)]


@pytest.mark.parametrize("docs, items", [([], [("a", "b")]), ([(1, "b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string") if not items else spark.createDataFrame(items, "item_id string, text string")
    assert lexical.search(left, right).collect() == []

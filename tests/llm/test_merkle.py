import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cinelake.llm import merkle
from cinelake.llm.manifest import tampered_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, c string, g int, root int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row[0], row[3], row[2], row[4], text]
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    steps = []
    for level in tree[:-1]:
        first = at // 8 * 8
        steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
        at //= 8
    return steps


def fold(node, steps):
    for left, right in steps:
        node = sha(left, node, right)
    return node


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for key in order:
        groups[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[key] = levels([leaf_of(r, r[1]) for r in groups[key]])
    top = levels([trees[key][-1][0] for key in order])
    out = []
    for place, key in enumerate(order):
        for at, row in enumerate(groups[key]):
            steps = path(trees[key], at) + path(top, place)
            odd = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            root = fold(leaf_of(row, lowered(row[1]) if odd else row[1]), steps)
            proof = sha(*[left + right for left, right in steps])
            out.append((row[0], trees[key][0][at], trees[key][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return sorted(out, key=repr)


def some(counts, seed=1):
    rng = random.Random(seed)
    texts = [None, "", "abc", "ABC é", "x" * 100_000, "Ünï\x00 A", "  "]
    rows = [
        (number, rng.choice(texts), lang, rng.choice([None, "", "web"]), rng.choice([None, 0, 7]), "l", "c", 1, 2)
        for number, lang in enumerate(lang for lang, count in counts.items() for _ in range(count))
    ]
    rng.shuffle(rows)
    return rows


CASES = {
    "a few": some({None: 1, "": 8, "de": 9, "en": 65, "é": 2}),
    "more than a block": some({"en": 1025, None: 513, "a": 64}),
    "many groups": some({f"l{n}": 1 + n % 3 for n in range(70)}),
    "one row": some({"en": 1}),
    "ties": some({"en": 5}) * 3 + [(None, "A", "en", None, None, "", "", 0, 0)] * 2 + [(2, "B", "en", None, None, "", "", 0, 0)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_against_plain_python(spark, name):
    rows = CASES[name]
    got = tampered_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert tampered_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_three_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)  # blocks of eight, so that 65 rows need three tiers
    rows = some({"en": 65, "de": 7})
    got = tampered_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_paths_fold_and_ids_of_text(spark):
    docs = spark.createDataFrame([(f"d{n}", f"t{n}") for n in range(20)], "key string, body string")
    found = merkle.manifest(docs, "key", "key", ("key", "body"), {"twice": F.concat("body", "body")})
    rows = found.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(rows) == 20 and all(r.again == r.root and r.leaf == r.subroot and r.rank == 0 for r in rows)
    assert {r.key: r.twice for r in rows}["d3"] == "t3t3"

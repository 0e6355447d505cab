import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path

from cinelake.llm import packing

TOKENIZER = path("word_bpe_49k.json")


def encode(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.fixture(scope="module")
def fresh():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def some():
    rng = random.Random(4)
    words = ["Hello", "it's", "WORLD", "état", "x=1;", "naïve", "don't", "日本", "3.14", "<|endoftext|>", "a" * 70, "--", "Σας", "I"]
    text = lambda most: "".join(w + rng.choice([" ", "\n", "", "\t"]) for w in rng.choices(words, k=rng.randint(0, most)))
    rows = [(f"d{n}", text(rng.choice([2, 40, 400]))) for n in range(150)]
    return rows + [("null", None), ("null", None), ("empty", ""), (None, "x"), ("long", "some words " * 9000), ("d1", rows[1][1])]


def test_against_a_plain_tokenizer(spark, fresh, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_BINS", 20)  # several rounds
    rows, size = some(), 64
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id string, text string, offset int, members int").repartition(3)
    out = packing.pack(packing.tokenize(df, TOKENIZER, size), size).collect()
    expected = []
    for doc_id, text in rows:
        ids = encode(fresh, text)
        for piece, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            expected.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=key) == sorted(expected, key=key)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(e[3] for e in expected) // size)
    assert least <= len(bins) <= 1.1 * least + 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenize(empty, TOKENIZER)).collect() == []


def test_long_texts_are_encoded_in_slices(fresh):
    unit = "One day, naïve people said: 'it's fine' — 3 times.\n"
    ids, known = encode(fresh, unit)[:-1], packing.TextIds(TOKENIZER)
    count = 50_000_000 // len(unit.encode())
    found = known.of_long(unit.encode() * count)
    assert len(found) == count * len(ids) and (found.reshape(count, -1) == np.array(ids)).all()


def test_runs_of_one_hash_are_told_apart(fresh, monkeypatch):
    monkeypatch.setattr(packing, "mixed", lambda values: values & np.uint64(3))  # nearly all runs collide
    known, texts = packing.TextIds(TOKENIZER), [f"word{n} and n{n}" for n in range(50)]
    assert [f.tolist() for f in known.of([t.encode() for t in texts])] == [encode(fresh, t)[:-1] for t in texts]

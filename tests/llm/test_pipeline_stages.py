import random
import re

import numpy as np
import pytest

import corpus_pipeline
from cinelake.llm import language

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, n_words string, "
    "n_hit int, contaminated string, __text string, __row int, row int, before string, gone int, c1 string"
)
REST = ("s", 1, "w", 2, "c", "t", 3, 4, "b", 5, "c1")


def folded(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def spans_cut(text, items, width=13):
    """(contaminated, text without the spans of lesser hits) by comparing every window."""
    windows = set()
    for _, item in items:
        w = [folded(x) for x in WORD.findall(item or "")]
        windows |= {tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)} if w else set()
    found = list(WORD.finditer(text or ""))
    words, hit = [folded(m[0]) for m in found], [False] * len(found)
    for window in windows:
        for at in range(len(words) - len(window) + 1):
            if tuple(words[at : at + len(window)]) == window:
                hit[at : at + len(window)] = [True] * len(window)
    if any(hit) and 20 * sum(hit) >= len(hit):
        return True, None
    out, at = "", 0
    for i, (m, h) in enumerate(zip(found, hit)):
        if h and not (i and hit[i - 1]):
            out += text[at : m.start()]
        if h:
            at = m.end()
    return False, None if text is None else out + text[at:]


@pytest.fixture
def folder(spark, tmp_path):
    items = [("a", "W0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), ("b", "Short É item"), (None, "nameless ONE"), ("n", None), ("e", "--")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), items


def documents():
    rng = random.Random(2)
    filler = lambda n: [rng.choice(["The", "I", "Quick", "brown", "É", "x_y", "End.", "(so)", "don't"]) for _ in range(n)]
    passage = "W0, w1 w2\nW3 w4 w5 w6 w7 w8 W9 w10 w11 w12".split(" ")
    texts = [None, "", "  ", "--- 12", " ".join(filler(3000)), "é" * 100_000]
    for n in range(40):
        own = filler(rng.choice([5, 400, 700]))
        at = rng.randrange(len(own))
        planted = rng.choice([passage, passage + ["w13"], ["short", "é", "ITEM"], ["Nameless", "one"], passage[:-1], []])
        texts.append(" ".join(own[:at] + planted + own[at:]))
    rows = [(n, t, "en", "web", len(t) if t else 0, *REST) for n, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (None, texts[8], None, None, None, *REST)]


def test_benchmark_spans_are_cut(spark, folder):
    directory, items = folder
    rows = documents()
    got = corpus_pipeline.decontaminated(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), directory)
    assert got.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    expected = []
    for row in rows:
        gone, text = spans_cut(row[1], items)
        if not gone:
            expected.append((row[0], text, *row[2:4], row[4] if text == row[1] else len(text), *row[5:]))
    assert any(e[1] != r[1] for e in expected for r in rows if r[0] == e[0])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(expected, key=repr)


def plain_vector(text, dimensions):
    table, letters = language._symbols(), language._letters(dimensions).astype(int)
    codes = [0, *[int(table[ord(c)]) for c in text], 0]
    total = np.zeros(dimensions, int)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total


def test_languages_by_plain_vectors(spark):
    rng = random.Random(3)
    words = {"aa": ["tri", "lo", "bra", "ÉTÉ"], "bb": ["zork", "mug", "Wex"], "cc": ["日本", "語", "ññ"]}
    rows = [(n, " ".join(rng.choices(words[lang], k=rng.randint(1, 30))), lang) for n, lang in enumerate(["aa", "bb", "cc"] * 15)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 --", "aa"), (103, "tri zork", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(df, language.prototypes(df, 256), ["doc_id", "lang"]).collect()}
    sums = {name: sum(plain_vector(t, 256) for _, t, lang in rows if lang == name and t) for name in words}
    for doc_id, text, _ in rows:
        own = plain_vector(text or "", 256)
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        cosines = {n: float(own @ s / np.linalg.norm(own) / np.linalg.norm(s)) for n, s in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert got[doc_id].lang_pred == best and abs(got[doc_id].score - max(0, cosines[best])) < 1e-4


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_with_clashing_names_and_without_rows(spark, folder, name, stage):
    df = spark.createDataFrame(documents(), SCHEMA)
    out, empty = stage(spark, df, folder[0]), stage(spark, df.limit(0), folder[0])
    assert empty.count() == 0
    if name != "best_fit_packing":
        assert out.columns == empty.columns == df.columns
        ids = {r.doc_id for r in out.collect()}
        assert ids <= {r[0] for r in documents()} and len(ids) > 3


def test_stages_keep_clean_documents(spark, folder):
    rng = random.Random(9)
    text = lambda: "\n".join(" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(9)) for _ in range(6))
    rows = [(n, text(), "en", "web", 9, *REST) for n in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:4]:
        df = stage(spark, df, folder[0])
        assert sorted(r.text for r in df.collect()) == sorted(r[1] for r in rows), name

import math
from collections import Counter, defaultdict

import pytest

from cinelake.llm import ngram_model


def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
    return [0.0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), i) if n[i] else y for i in (1, 2, 3)]


def brute(train, texts):
    split = lambda t: (t or "").lower().split() + ["</s>"]
    pairs, unigrams = Counter(), Counter()
    for t in train:
        w = split(t)
        unigrams.update(w)
        pairs.update(zip(["<s>"] + w, w))
    contexts, follow = defaultdict(dict), Counter()
    for (u, w), c in pairs.items():
        contexts[u][w] = c
        follow[w] += 1
    dp, dw = discounts(pairs.values()), discounts(follow.values())
    types, v, n = len(pairs), len(unigrams), sum(unigrams.values())
    gamma = sum(dw[min(c, 3)] for c in follow.values()) / types

    def lower(w):
        c = follow.get(w, 0)
        return max(c - dw[min(c, 3)], 0) / types + gamma / (v + 1)

    def chance(u, w):
        if u not in contexts:
            return lower(w)
        total = sum(contexts[u].values())
        c = contexts[u].get(w, 0)
        return max(c - dp[min(c, 3)], 0) / total + sum(dp[min(x, 3)] for x in contexts[u].values()) / total * lower(w)

    vocabulary = list(unigrams) + ["never seen"]
    for u in [*contexts, "never seen"]:
        assert abs(sum(chance(u, w) for w in vocabulary) - 1) < 1e-9
    out = []
    for t in texts:
        w = split(t)
        out.append((
            len(w), sum(x in unigrams for x in w), sum(math.log10((unigrams[x] + 1) / (n + v + 1)) for x in w),
            sum(math.log10(chance(*p)) for p in zip(["<s>"] + w, w)),
        ))
    return out, n


def test_against_brute_force(spark):
    texts = [
        "The cat sat on the mat", "the cat ran", "a dog sat on the cat", "THE the the the", "", None, "a b a b a b a c",
        "the cat sat", "the cat sat on a dog", "Ünï cödé the cat", "a dog ran", "a dog ran", "x " * 3000, "on the mat",
    ]
    unseen = ["unseen words here", "the dog", "cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = ngram_model.train(df, part_bytes=1000)
    every = spark.createDataFrame(list(enumerate(texts + unseen)), "doc_id long, text string")
    got = sorted(ngram_model.score(every, model, ["doc_id"]).collect())
    expected, tokens = brute(texts, texts + unseen)
    assert model.train_tokens == tokens
    for row, (count, known, base, score) in zip(got, expected, strict=True):
        assert (row.n_tokens, row.n_known) == (count, known)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(score, rel=1e-9)


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = ngram_model.score(df, ngram_model.train(df.limit(0)), ["doc_id"]).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)

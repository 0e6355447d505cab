"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule votes good, bad or nothing on a text. How often a rule votes what, given that
a text is good or bad, is estimated by expectation-maximisation over the counts of vote
patterns of all documents (at most 3 to the number of rules), starting from the
number of bad votes. A text is kept when the posterior probability of good is at least a half.

NULL and empty texts have no words, and fail the base rule. Repeated rows count each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import WordHashes, texts_of, windows
from cinelake.session import materialize

WINDOW = 8
ABSTAIN, BAD, GOOD = 0, 1, 2
RULES = (
    "length", "word_length", "symbols", "duplicate_lines", "repeated_words", "sentence_ends", "letters", "variety",
    "marked_words", "capitals", "stutter",
)
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SYMBOLS = b"#*$%&|<>"
_KEEP_SYMBOLS = bytes(b for b in range(256) if b not in _SYMBOLS)
_KEEP_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
_LATER_BYTES = bytes(range(0x80, 0xC0))
_BLANKS = b" \t\n\x0b\x0c\r"


def measures(text: bytes | None, known: WordHashes) -> tuple[int, int, int, int, int, list[bytes], int]:
    """(words, code points in words, symbols, duplicate lines, repeated words, word list, lines with a word)."""
    text = text or b""
    words = text.split()
    chars = len(text.translate(None, _LATER_BYTES + _BLANKS))
    symbols = len(text.translate(None, _KEEP_SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(_BLANKS)]
    repeated = 0
    if len(words) > WINDOW:
        _, back, counts = np.unique(windows(known.of(words), WINDOW), return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[back] > 1)
        if len(starts):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + WINDOW, -1)
            repeated = int((np.cumsum(change) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, words, len(lines)


def _vote(value: float, bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(text: bytes | None, found: tuple) -> list[int]:
    """Votes of ``RULES``, in their order."""
    count, chars, symbols, dup_lines, repeated, words, lines = found
    if not count:
        return [BAD] + [ABSTAIN] * (len(RULES) - 1)
    mean, symbol_share, dup_share, repeat_share = chars / count, symbols / count, dup_lines / max(lines, 1), repeated / count
    ends = sum(w[-1:] in (b".", b"!", b"?", b":") for w in words) / count
    lettered = sum(w[:1].isalpha() or w[0] >= 0x80 for w in words) / count
    variety = len(set(words)) / count
    marked = sum(len(w) != len(w.translate(None, _SYMBOLS)) for w in words) / count if symbols else 0.0
    capitals = len(text.translate(None, _KEEP_CAPITALS)) / chars
    stutter = sum(a == b for a, b in zip(words, words[1:])) / count
    return [
        _vote(count, count < 20, count >= 50),
        _vote(mean, mean < 2.5 or mean > 12, 3 <= mean <= 9),
        _vote(symbol_share, symbol_share > 0.1, symbol_share < 0.01),
        _vote(dup_share, dup_share > 0.3, dup_lines == 0),
        _vote(repeat_share, repeat_share > 0.2, repeat_share < 0.02),
        _vote(ends, ends < 0.01 or ends > 0.5, 0.02 <= ends <= 0.3),
        _vote(lettered, lettered < 0.7, lettered > 0.9),
        _vote(variety, variety < 0.2, variety > 0.35),
        _vote(marked, marked > 0.2, marked < 0.02),
        _vote(capitals, capitals > 0.3, capitals < 0.1),
        _vote(stutter, stutter > 0.2, stutter < 0.05),
    ]


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        rows, patterns = [], []
        for text in texts_of(batch.column(1)):
            found = measures(text, known)
            rows.append(found[:5])
            patterns.append(sum(v * 3**i for i, v in enumerate(votes(text, found))))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, pa.int64()) for c in columns] + [pa.array(patterns, pa.int64())],
            ["row_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "pattern"],
        )


def estimate(patterns: Counter[int], rules: int = len(RULES), turns: int = 100) -> tuple[dict[int, float], np.ndarray, float]:
    """(posterior of good per pattern, P(vote | class) per rule, P(good)), by EM with one
    made-up document per vote and class so that no chance is zero."""
    keys = sorted(patterns)
    if not keys:
        return {}, np.full((2, rules, 3), 1 / 3), 0.5
    cast = np.array([[k // 3**i % 3 for i in range(rules)] for k in keys])
    weight = np.array([patterns[k] for k in keys], float)
    # rules call bad what is far from usual, so one such vote casts doubt and two outweigh the rest
    good = np.choose(np.minimum((cast == BAD).sum(1), 2), [0.95, 0.5, 0.05])
    one_hot = cast[:, :, None] == np.arange(3)
    for _ in range(turns):
        last = good
        prior = (weight @ good + 1) / (weight.sum() + 2)
        chance = np.stack([np.einsum("k,krv->rv", weight * p, one_hot) + 1 for p in (1 - good, good)])
        chance /= chance.sum(axis=2, keepdims=True)
        logs = np.einsum("krv,crv->kc", one_hot, np.log(chance)) + np.log([1 - prior, prior])
        good = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        if np.abs(good - last).max() < 1e-9:
            break
    return dict(zip(keys, good.tolist())), chance, float(prior)


def judge(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every row as (id, measures, base_failed, quality, kept)."""
    picked = docs.select(F.col(f"`{id_column}`").alias("row_id"), F.col("text").cast("string").alias("text"))
    kind = picked.schema["row_id"].dataType.simpleString()
    measured = materialize(picked.mapInArrow(_measure, f"row_id {kind}, {FEATURES}, pattern long"), "measures")
    counts = Counter({r.pattern: r.n for r in measured.groupBy("pattern").agg(F.count("*").alias("n")).collect()})
    posterior, _, _ = estimate(counts)
    table = docs.sparkSession.createDataFrame(list(posterior.items()), "pattern long, quality double")  # at most 3^rules rows
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    joined = measured.join(F.broadcast(table), "pattern").withColumn("base_failed", failed)
    return joined.select(
        F.col("row_id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "quality", (~failed & (F.col("quality") >= 0.5)).alias("kept"),
    )

"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text and their first four and five letters, hashed.
A term has a weight and a short vector; the score adds the weights and the products of
all pairs of vectors, so that two terms can say together what neither says alone. Every
term met has a vector; the products of a text are divided by its number of terms, or a
long clean text would drown what it holds. For the same reason the weight alone, never
the vector, stays 0 for terms whose share of toxic rows lies within ``LEAST_DEVIATIONS``
standard deviations of the base rate.

The machine is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of their id
(a documented bound); every document is scored. NULL labels teach nothing, and a
document labelled twice counts twice. Without any labelled row all scores are 0.
Empty and NULL texts have no terms and get the base rate's score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import WordHashes, arrow_rows, texts_of

BITS, RANK, SAMPLE = 18, 4, 20_000
LEAST_DEVIATIONS = 4.0
_WORD = regex.compile(r"\p{L}+")


def terms_of(text: bytes | None, known: WordHashes, bits: int = BITS) -> np.ndarray:
    """Sorted numbers of the distinct terms of a text."""
    words = set(_WORD.findall((text or b"").decode("utf-8", "replace").lower()))
    terms = {w.encode() for w in words}
    for size in (4, 5):
        terms |= {b"%d^" % size + w[:size].encode() for w in words if len(w) > size}
        terms |= {b"%d^" % size + w.encode() for w in words if len(w) == size}
    return np.unique(known.of(list(terms)) >> np.uint64(64 - bits)).astype(np.int64)


class Machine:
    def __init__(self, bits: int = BITS, rank: int = RANK):
        self.bits, self.bias = bits, -20.0
        self.weights = np.zeros(1 << bits, np.float32)
        self.vectors = np.zeros((1 << bits, rank), np.float32)

    def margins(self, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Margins of texts whose terms lie one after another; a text may have none."""
        return self._sums(terms, starts)[0]

    def _sums(self, terms: np.ndarray, starts: np.ndarray):
        edges = np.r_[starts, len(terms)]

        def added(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)])
            return total[edges[1:]] - total[edges[:-1]]

        vectors = self.vectors[terms]
        sums = added(vectors)
        pairs = (sums**2).sum(axis=1) - added(vectors**2).sum(axis=1)
        pairs /= 2 * np.maximum(np.diff(edges), 1)
        return self.bias + added(self.weights[terms][:, None])[:, 0] + pairs, sums, vectors

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, epochs: int = 6, batch: int = 256) -> "Machine":
        rng = np.random.default_rng(7)
        terms, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
        seen = np.bincount(terms, minlength=1 << self.bits)
        toxic = np.bincount(terms, np.repeat(labels, lengths), minlength=1 << self.bits)
        rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        telling = np.abs(toxic - rate * seen) > LEAST_DEVIATIONS * np.sqrt(rate * (1 - rate) * np.maximum(seen, 1))
        self.bias = float(np.log(rate / (1 - rate)))
        self.vectors[seen > 0] = rng.normal(0, 0.05, (int((seen > 0).sum()), self.vectors.shape[1]))
        squares_w, squares_v = np.full(len(self.weights), 1e-6, np.float32), np.full(self.vectors.shape, 1e-5, np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                terms = np.concatenate([rows[i] for i in some])
                lengths = np.array([len(rows[i]) for i in some])
                margins, sums, vectors = self._sums(terms, np.cumsum(lengths) - lengths)
                slope = 1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels[some]
                each = np.repeat(slope, lengths)
                used, back = np.unique(terms, return_inverse=True)
                grad_w = telling[used] * (np.bincount(back, each) / len(some) + 2e-5 * self.weights[used])
                pull = np.repeat(slope / np.maximum(lengths, 1), lengths)[:, None] * (np.repeat(sums, lengths, axis=0) - vectors)
                grad_v = np.stack([np.bincount(back, p) for p in pull.T], axis=1) / len(some) + 2e-4 * self.vectors[used]
                squares_w[used] += grad_w**2
                squares_v[used] += grad_v**2
                self.weights[used] -= 0.1 * grad_w / np.sqrt(squares_w[used])
                self.vectors[used] -= 0.4 * grad_v / np.sqrt(squares_v[used])
                self.bias -= 0.05 * float(slope.mean())
        return self


def _collectable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for labels, texts in arrow_rows(batches, "label", "text"):
        found = [terms_of(t, known).astype("<i4").tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.binary())], ["label", "terms"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id, label) whose document is in ``docs``."""
    chosen = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.select("label", "text").mapInArrow(_collectable, "label int, terms binary").limit(2 * sample).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.terms, r.label))  # the order of arrival must not matter
    return Machine().fit([np.frombuffer(r.terms, "<i4").astype(np.int64) for r in rows], np.array([r.label for r in rows], float))


def _score(machine):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = WordHashes(), machine.value if machine is not None else None
        for batch in batches:
            texts = texts_of(batch.column("text"))
            scores = np.zeros(len(texts))
            for at in range(0, len(texts) if model else 0, 512):
                found = [terms_of(t, known, model.bits) for t in texts[at : at + 512]]
                lengths = np.array([len(f) for f in found])
                margins = model.margins(np.concatenate(found), np.cumsum(lengths) - lengths)
                scores[at : at + 512] = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.names.index(n)) for n in names] + [pa.array(scores)], [*names, "score"]
            )

    return run


def score(docs: DataFrame, machine: Machine | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` (without ``text``) of every row, with ``score`` in 0 to 1."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "text")
    sent = docs.sparkSession.sparkContext.broadcast(machine) if machine is not None else None  # 2^BITS x (RANK + 1) numbers
    return picked.mapInArrow(_score(sent), f"{schema}, score double")

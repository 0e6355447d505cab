"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Pairs of 64-bit word hashes are counted per task, sent to the part of their context,
merged there, and stored as arrays sorted by hash: pairs with their counts, contexts
with their totals, words with the number of contexts they follow. Workers memory-map the
arrays and look up whole batches by binary search.

A token's probability is the discounted count of its pair, plus what the discounts left
times the continuation probability of the word, which is interpolated with a uniform one
over the known words and one unknown. Discounts follow from counts of counts.

The arrays lie in the folder of ``spark.checkpoint.dir``, which has to be mounted on the
driver and all executors for memory-mapping. Files are written under a name of their own
and renamed, so a task that runs again leaves the same file.

A text is its words and one end token; NULL is empty text. Repeated rows count each.
Without training rows every token has probability 1.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import WordHashes, mixed, slices, texts_of
from cinelake.session import new_path

START, END = np.uint64(1), np.uint64(2)
# Tokens a task counts at a time, and bytes of text to a part of the model.
_CHUNK, PART_BYTES = 3_000_000, 16 << 20
_PAYLOAD = "part int, kind int, a binary, b binary, c binary"


def tokens_of(texts: list[bytes | None], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens in a row, tokens per text); every text ends with ``END``."""
    words = [(t or b"").lower().split() for t in texts]
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    out = np.full(int(lengths.sum()), END, np.uint64)
    mask = np.ones(len(out), bool)
    mask[np.cumsum(lengths) - 1] = False
    out[mask] = known.of([w for some in words for w in some])
    return out, lengths


def contexts_of(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    before = np.r_[START, tokens[:-1]]
    before[np.cumsum(lengths) - lengths] = START
    return before


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(context) + word)


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(words) % np.uint64(parts)).astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "kind", "a", "b", "c"])


def _by_part(parts: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Slices of equal values in sorted ``parts``."""
    edges = np.searchsorted(parts, np.arange(count + 1))
    for part in range(count):
        if edges[part] < edges[part + 1]:
            yield part, slice(edges[part], edges[part + 1])


def _count(parts: int):
    def counted(context: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = pair_key(context, word)
        _, index, counts = np.unique(keys, return_index=True, return_counts=True)
        context, word = context[index], word[index]
        part = part_of(context, parts)
        order = np.lexsort((context, part))
        context, word, counts, part = context[order], word[order], counts[order].astype("<u4"), part[order]
        for number, some in _by_part(part, parts):
            yield _rows([(number, 0, context[some].tobytes(), word[some].tobytes(), counts[some].tobytes())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = WordHashes(), [], 0
        for batch in batches:
            texts = texts_of(batch.column(0))
            for some in slices(texts, 1 << 30, 1 << 20):
                tokens, lengths = tokens_of(texts[some], known)
                held.append((contexts_of(tokens, lengths), tokens))
                size += len(tokens)
                if size >= _CHUNK:
                    yield from counted(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
        if held:
            yield from counted(*(np.concatenate(x) for x in zip(*held)))

    return run


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Files ``<name>.<array>.npy``, each renamed into place when whole."""
    for key, values in arrays.items():
        path = os.path.join(folder, f"{name}.{key}.npy")
        with open(own := f"{path}.{uuid.uuid4().hex}", "wb") as out:
            np.save(out, values)
        os.replace(own, path)


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Payload rows of one part after the other; rows come sorted by part, statistics first."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield held[0][0], held
                held = []
            held.append(row)
    if held:
        yield held[0][0], held


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == n).sum()) for n in (1, 2, 3, 4)]


def _merge_pairs(folder: str, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches):
            context, word = (np.frombuffer(b"".join(r[i] for r in rows), np.uint64) for i in (2, 3))
            counts = np.frombuffer(b"".join(r[4] for r in rows), "<u4").astype(np.int64)
            keys, index, back = np.unique(pair_key(context, word), return_index=True, return_inverse=True)
            counts = np.bincount(back, counts).astype(np.int64)
            context, word = context[index], word[index]
            _save(folder, f"pairs-{part}", keys=keys, counts=np.minimum(counts, 2**32 - 1).astype(np.uint32))
            names, back = np.unique(context, return_inverse=True)
            few = [np.bincount(back[pick], minlength=len(names)) for pick in (counts == 1, counts == 2, counts > 2)]
            _save(
                folder, f"contexts-{part}", keys=names, totals=np.bincount(back, counts).astype(np.int64),
                few=np.stack(few, axis=1).astype(np.uint32),
            )
            real = names != START
            tokens = int(counts[context != START].sum())
            stats = np.array([*_counts_of_counts(counts), tokens, int(real.sum())], np.int64)
            follow, times = np.unique(word, return_counts=True)
            to = part_of(follow, parts)
            order = np.argsort(to, kind="stable")
            follow, times, to = follow[order], times[order].astype("<u4"), to[order]
            yield _rows([(part, 1, stats.tobytes(), b"", b"")])
            for number, some in _by_part(to, parts):
                yield _rows([(number, 2, follow[some].tobytes(), times[some].tobytes(), b"")])

    return run


def _merge_words(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches):
            for row in rows:
                if row[1] == 1:
                    yield _rows([row])
            rows = [r for r in rows if r[1] == 2]
            word = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
            times = np.frombuffer(b"".join(r[3] for r in rows), "<u4")
            names, back = np.unique(word, return_inverse=True)
            times = np.bincount(back, times, minlength=len(names)).astype(np.int64)
            _save(folder, f"words-{part}", keys=names, times=times)
            more = [int((times > 2).sum()), int(times.sum())]
            yield _rows([(part, 2, np.array([*_counts_of_counts(times), *more], np.int64).tobytes(), b"", b"")])

    return run


def _discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    out = [0.0]
    for i, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        out.append(float(np.clip(i - (i + 1) * y * high / low, 0.0, i)) if low else y)
    return np.array(out)


@dataclass
class Model:
    """Constants of a stored model. ``vocabulary`` and ``train_tokens`` count the end token."""

    folder: str
    parts: int
    train_tokens: int
    vocabulary: int
    ends: int
    pair_types: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    uniform_weight: float


def train(docs: DataFrame, part_bytes: int = PART_BYTES) -> Model:
    """Count and store the model of all texts of ``docs``."""
    spark = docs.sparkSession
    url = urlparse(new_path(spark, "ngrams"))
    if url.scheme not in ("", "file"):
        raise RuntimeError("the model is memory-mapped: spark.checkpoint.dir must be a mounted folder (file:)")
    folder = url.path
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    size, ends = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts = max(2, -(-(size or 0) // part_bytes))
    pairs = texts.mapInArrow(_count(parts), _PAYLOAD).repartition(parts, "part").sortWithinPartitions("part")
    words = pairs.mapInArrow(_merge_pairs(folder, parts), _PAYLOAD).repartition(parts, "part").sortWithinPartitions("part", "kind")
    rows = words.mapInArrow(_merge_words(folder), _PAYLOAD).select("kind", "a").collect()  # two short rows per part
    of_pairs = sum((np.frombuffer(r.a, np.int64) for r in rows if r.kind == 1), np.zeros(6, np.int64))
    of_words = sum((np.frombuffer(r.a, np.int64) for r in rows if r.kind == 2), np.zeros(6, np.int64))
    discounts = _discounts(of_words[:4])
    types = int(of_words[5])
    left = discounts[1] * of_words[0] + discounts[2] * of_words[1] + discounts[3] * of_words[4]
    return Model(
        folder, parts, int(of_pairs[4]) + ends, int(of_pairs[5]) + (ends > 0), ends, types,
        _discounts(of_pairs[:4]), discounts, float(left / types) if types else 1.0,
    )


class Reader:
    """The stored arrays of a model, memory-mapped."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def _array(self, name: str) -> np.ndarray | None:
        if name not in self.open:
            path = os.path.join(self.model.folder, f"{name}.npy")
            self.open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.open[name]

    def _look_up(self, kind: str, part: np.ndarray, keys: np.ndarray, *columns: str) -> list[np.ndarray]:
        """Values of each key in its part's arrays, 0 where it is not there. ``keys`` may repeat."""
        out: list[np.ndarray | None] = [None] * len(columns)
        order = np.lexsort((keys, part))
        for number, some in _by_part(part[order], self.model.parts):
            stored = self._array(f"{kind}-{number}.keys")
            if stored is None or not len(stored):
                continue
            own = order[some]
            at = np.searchsorted(stored, keys[own])
            at[at == len(stored)] = 0
            hit = stored[at] == keys[own]
            for i, column in enumerate(columns):
                values = self._array(f"{kind}-{number}.{column}")
                if out[i] is None:
                    out[i] = np.zeros((len(keys), *values.shape[1:]))
                out[i][own[hit]] = values[at[hit]]
        return [np.zeros((len(keys), 3) if c == "few" else len(keys)) if o is None else o for c, o in zip(columns, out)]

    def scores(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of each token after its context, its count in training)."""
        model = self.model
        context = contexts_of(tokens, lengths)
        words, back = np.unique(tokens, return_inverse=True)
        part = part_of(words, model.parts)
        (times,) = self._look_up("words", part, words, "times")
        counts, few = self._look_up("contexts", part, words, "totals", "few")
        counts[words == END] = model.ends
        base = 1.0 / (model.vocabulary + 1)
        known = np.maximum(times - model.word_discounts[np.minimum(times, 3).astype(int)], 0)
        lower = known / max(model.pair_types, 1) + model.uniform_weight * base
        totals, lefts = self._left(context, words, back, counts, few)
        keys, same = np.unique(pair_key(context, tokens), return_index=True)
        place = np.searchsorted(keys, pair_key(context, tokens))
        (pairs,) = self._look_up("pairs", part_of(context[same], model.parts), keys, "counts")
        pairs = pairs[place]
        kept = np.maximum(pairs - model.pair_discounts[np.minimum(pairs, 3).astype(int)], 0)
        seen = totals > 0
        safe = np.where(seen, totals, 1)
        return np.where(seen, kept / safe + lefts / safe * lower[back], lower[back]), counts[back]

    def _left(self, context, words, back, counts, few) -> tuple[np.ndarray, np.ndarray]:
        """Totals of the contexts and the mass their discounts leave. A context is the token
        before, so its row is known already, but for the start."""
        left = few @ self.model.pair_discounts[1:]
        start = part_of(np.array([START]), self.model.parts)
        total, few_start = self._look_up("contexts", start, np.array([START]), "totals", "few")
        totals, lefts = np.r_[total[0], counts[back[:-1]]], np.r_[0.0, left[back[:-1]]]
        first = context == START
        totals[first], lefts[first] = total[0], (few_start @ self.model.pair_discounts[1:])[0]
        return totals, lefts


def _score(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reader = WordHashes(), Reader(model)
        scale = model.train_tokens + model.vocabulary + 1
        for batch in batches:
            texts = texts_of(batch.column("text"))
            columns: list[list] = [[], [], [], []]
            for some in slices(texts, 1 << 30, 1 << 20):
                tokens, lengths = tokens_of(texts[some], known)
                chance, counts = reader.scores(tokens, lengths)
                starts = np.cumsum(lengths) - lengths
                columns[0] += lengths.tolist()
                columns[1] += np.add.reduceat((counts > 0).astype(np.int64), starts).tolist()
                columns[2] += np.add.reduceat(np.log10((counts + 1) / scale), starts).tolist()
                columns[3] += np.add.reduceat(np.log10(np.maximum(chance, 1e-300)), starts).tolist()
            names = [n for n in batch.schema.names if n != "text"]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.names.index(n)) for n in names] + [pa.array(c, t) for c, t in zip(columns, types)],
                [*names, "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` (without ``text``) of every row with its tokens and log10 probabilities:
    ``base_score`` by add-one words, ``score`` by the model. Perplexity is 10^(-score/n_tokens)."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "text")
    return picked.mapInArrow(_score(model), f"{schema}, n_tokens long, n_known long, base_score double, score double")

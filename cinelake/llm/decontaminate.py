"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents of one task. Its words become symbols of the
benchmark's vocabulary; words that no benchmark has end a phrase, so each run of them is
one terminator. Test phrases (windows of ``width`` words, or whole shorter items) are
found by backward search, located by sampled suffix positions, and their spans merged.

Documents never leave their task. The benchmark goes to the workers in parts of at most
``PART_BYTES`` of text (an item is never split), of which a task holds one at a time.

NULL and empty texts have no words and are clean. Repeated documents are judged each
by itself; repeated items count once per ``item_id``. An item without id is looked for
like any other, but neither counted nor named among the items found. An empty benchmark hits nothing,
an empty table of documents gives no rows. A kept column that has the name of a result gives way to it.
A very long text is a shard of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import slices, texts_of
from cinelake.llm.fm_index import FMIndex

WIDTH = 13
PART_BYTES = 8 << 20
_SHARD_DOCS, _SHARD_BYTES = 4096, 4 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case words of ASCII letters, digits and everything beyond ASCII."""
    return (text or b"").translate(_FOLD).split()


class Phrases:
    """Distinct windows of some benchmark items, as symbols of their vocabulary."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(len(symbols) - width, 0) + 1 if symbols else 0):
                owner = owners.setdefault(tuple(symbols[at : at + width]), set())
                if item_id is not None:
                    owner.add(item_id)
        self.owners = [sorted(o) for o in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.symbols = np.zeros((len(owners), width), np.int64)
        for row, window in zip(self.symbols, owners):
            row[: len(window)] = window


def _occurrences(words: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word place) of every occurrence in the words of a shard, given as symbols."""
    keep = np.r_[True, (words[1:] != 0) | (words[:-1] != 0)] if len(words) else np.zeros(0, bool)
    where = np.flatnonzero(keep)
    index = FMIndex(np.r_[words[where], 0], len(phrases.vocabulary))
    low, high = index.search(phrases.symbols, phrases.lengths)
    counts = np.maximum(high - low, 0)
    phrase = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return phrase, where[index.locate(rows)]


def search_shard(texts: list[bytes | None], parts: Iterable[Phrases]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """(words per text, mask of the hit words of all texts in a row, items found per text)."""
    words = [words_of(text) for text in texts]
    counts = np.array([len(w) for w in words], np.int64)
    firsts = np.cumsum(counts + 1) - counts - 1  # a terminator after each text
    total = int(counts.sum()) + len(texts)
    change, items = np.zeros(total + 1, np.int64), [set() for _ in texts]
    for phrases in parts:
        if not len(phrases.lengths):
            continue
        get = phrases.vocabulary.get
        symbols = np.zeros(total, np.int64)
        for first, some in zip(firsts.tolist(), words):
            symbols[first : first + len(some)] = [get(w, 0) for w in some]
        phrase, place = _occurrences(symbols, phrases)
        np.add.at(change, place, 1)
        np.add.at(change, place + phrases.lengths[phrase], -1)
        owner = np.searchsorted(firsts, place, "right") - 1
        for text, number in set(zip(owner.tolist(), phrase.tolist())):
            items[text].update(phrases.owners[number])
    return counts, np.cumsum(change)[:total] > 0, items


def cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words; each merged span goes with what lies inside it.
    Folding keeps the number of bytes, so spans of the folded text hold for the text itself."""
    spans = [m.span() for m in re.finditer(rb"\S+", text.translate(_FOLD))]
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    out, at = [], 0
    for first, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(text[at : spans[first][0]])
        at = spans[stop - 1][1]
    return b"".join([*out, text[at:]])


RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _scan(parts: list[Broadcast], numerator: int, denominator: int, cleaned: bool):
    def loaded() -> Iterator[Phrases]:
        for part in parts:
            yield part.value
            if len(parts) > 1 and hasattr(part, "_value"):
                del part._value  # one part in memory at a time; it is read again from the local copy

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for some in slices(texts, _SHARD_DOCS, _SHARD_BYTES):
                shard = texts[some]
                counts, mask, items = search_shard(shard, loaded())
                firsts = np.cumsum(counts + 1) - counts - 1
                hits = np.add.reduceat(np.r_[mask, False].astype(np.int64), firsts) if len(firsts) else np.zeros(0, np.int64)
                bad = (hits > 0) & (denominator * hits >= numerator * counts)
                columns = [batch.column(i).slice(some.start, some.stop - some.start) for i in range(batch.num_columns)]
                names = list(batch.schema.names)
                if cleaned:
                    new = [
                        cut(t, mask[f : f + n]) if h and not b else t
                        for t, f, n, h, b in zip(shard, firsts.tolist(), counts.tolist(), hits.tolist(), bad.tolist())
                    ]
                    columns[names.index("text")] = pa.array(new, pa.binary()).cast(pa.string())
                else:
                    del columns[names.index("text")], names[names.index("text")]
                digests = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]
                yield pa.RecordBatch.from_arrays(
                    columns
                    + [
                        pa.array(counts), pa.array(hits.astype(np.int64)), pa.array([len(i) for i in items], pa.int64()),
                        pa.array(digests, pa.string()), pa.array(bad),
                    ],
                    [*names, *RESULTS],
                )

    return run


def phrase_parts(benchmark: DataFrame, width: int = WIDTH, part_bytes: int = PART_BYTES) -> list[Broadcast]:
    """The benchmark's phrases in broadcast parts of about ``part_bytes`` of text each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    out = []
    for number in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == number) if parts > 1 else items
        rows = [(r.item_id, r.text.encode()) for r in own.where("text IS NOT NULL").toLocalIterator()]
        out.append(spark.sparkContext.broadcast(Phrases(rows, width)))
    return out


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    width: int = WIDTH,
    share: tuple[int, int] = (1, 20),
    cleaned: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Columns ``keep`` of every document with its hits.

    A document is contaminated when the hit words are at least ``share`` of its words.
    With ``cleaned`` the column ``text`` must be kept; hit spans are cut out of the
    documents that are not contaminated.
    """
    keep = [c for c in keep if c.lower() not in RESULTS]
    picked = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    fields = [f for f in picked.schema if cleaned or f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = phrase_parts(benchmark, width, part_bytes)
    return picked.mapInArrow(_scan(parts, *share, cleaned), f"{schema}, {RESULT}")

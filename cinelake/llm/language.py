"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product (binding)
of its letters' vectors, each rotated (permuted) by its place; a text is the sum
(bundle) of its n-grams, and a language the sum of its training texts. A text gets the
language whose prototype has the largest cosine.

NULL texts and texts without a letter are ``und`` with score 0. Rows without a language
teach nothing. Ties go to the first language by name. Without any training row every
text is ``und``. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import slices, texts_of

UNKNOWN = "und"
WIDTH = 3
DIMENSIONS = 1024
_SYMBOLS = 64  # 0 parts words, 1-26 are a-z, the other letters share 27-63
_ROWS, _BYTES = 512, 1 << 20


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Symbol of every code point, letters folded to lower case where that is one letter."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha() or unicodedata.category(char)[0] == "L":
            low = char.lower()
            code = ord(low) if len(low) == 1 else point
            table[point] = code - 96 if 97 <= code <= 122 else 27 + (code * 2654435761 >> 7) % (_SYMBOLS - 27)
    return table


@lru_cache(4)
def _letters(dimensions: int) -> np.ndarray:
    draw = np.random.default_rng(20_09).integers(0, 2, (_SYMBOLS, dimensions), dtype=np.int8)
    return draw * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of the given n-gram numbers (six bits per symbol)."""
    letters, out = _letters(dimensions), None
    for place in range(WIDTH):
        symbols = grams >> (6 * (WIDTH - 1 - place)) & (_SYMBOLS - 1)
        rotated = np.roll(letters, WIDTH - 1 - place, axis=1)[symbols]
        out = rotated if out is None else out * rotated
    return out.astype(np.float32)


def count_grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the text, n-gram, has the text a letter): one entry per n-gram of all texts.

    An n-gram has a letter in its middle, so none reaches from one text into the next.
    """
    codes = []
    for text in texts:
        points = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        codes.append(_symbols()[points])
    lengths = np.array([len(c) for c in codes], np.int64)
    gap = np.zeros(1, np.uint8)
    joined = np.concatenate([gap] + [part for c in codes for part in (c, gap)]).astype(np.int32)
    rows = np.repeat(np.arange(len(texts)), lengths + 1)
    grams = joined[:-2] << 12 | joined[1:-1] << 6 | joined[2:]
    inner = joined[1:-1] > 0
    lettered = np.bincount(rows[:-1][inner] if len(rows) else rows, minlength=len(texts)) > 0
    return rows[:-1][inner], grams[inner], lettered


def _sums(dimensions: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = texts_of(batch.column(0)), batch.column(1).to_pylist()
            for part in slices(texts, 1 << 30, _BYTES):
                names, numbers = np.unique(np.array(langs[part], object).astype(str), return_inverse=True)
                rows, grams, _ = count_grams(texts[part])
                for number, name in enumerate(names):
                    if name not in totals:
                        totals[name] = np.zeros(_SYMBOLS**WIDTH, np.int64)
                    totals[name] += np.bincount(grams[numbers[rows] == number], minlength=_SYMBOLS**WIDTH)
        for name, counts in totals.items():
            seen = np.flatnonzero(counts)
            vector = np.zeros(dimensions)
            for start in range(0, len(seen), 8192):
                some = seen[start : start + 8192]
                vector += counts[some] @ gram_vectors(some, dimensions).astype(np.float64)
            yield pa.RecordBatch.from_pydict(
                {"lang": [name] * dimensions, "place": np.arange(dimensions), "value": vector.astype(np.int64)}
            )

    return run


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their bundled vectors, learned from all rows of
    (text, lang). What reaches the driver is one vector per language."""
    rows = (
        labelled.select("text", F.col("lang").cast("string").alias("lang"))
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(_sums(dimensions), "lang string, place long, value long")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    names = sorted({r.lang for r in rows})
    vectors = np.zeros((len(names), dimensions))
    at = {name: i for i, name in enumerate(names)}
    for r in rows:
        vectors[at[r.lang], r.place] = r.value
    return names, vectors


def _judge(names: list[str], vectors: np.ndarray, schema: pa.Schema):
    dimensions = vectors.shape[1]
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    units = (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            langs, scores = [], []
            for part in slices(texts, _ROWS, _BYTES):
                rows, grams, lettered = count_grams(texts[part])
                count = len(lettered)
                if not len(grams) or not names:
                    langs += [UNKNOWN] * count
                    scores += [0.0] * count
                    continue
                seen = np.flatnonzero(np.bincount(grams, minlength=_SYMBOLS**WIDTH))
                column = np.zeros(_SYMBOLS**WIDTH, np.int64)
                column[seen] = np.arange(len(seen))
                bundle = np.zeros((count, dimensions), np.float32)
                for start in range(0, len(seen), 8192):
                    some = seen[start : start + 8192]
                    inside = (column[grams] >= start) & (column[grams] < start + len(some))
                    cells = rows[inside] * len(some) + column[grams[inside]] - start
                    table = np.bincount(cells, minlength=count * len(some)).reshape(count, len(some))
                    bundle += table.astype(np.float32) @ gram_vectors(some, dimensions)
                length = np.linalg.norm(bundle, axis=1, keepdims=True)
                cosines = bundle @ units.T / np.where(length > 0, length, 1)
                best = np.argmax(np.round(cosines, 6), axis=1)
                langs += [names[b] if has else UNKNOWN for b, has in zip(best, lettered)]
                top = np.clip(cosines[np.arange(count), best].astype(float), 0, 1)
                scores += list(np.where(lettered, top, 0.0))
            kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name in schema.names]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [batch.schema.field(i).name for i, f in enumerate(batch.schema) if f.name in schema.names]
                + ["lang_pred", "score"],
            )

    return run


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str]
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``; reads column ``text``. A
    kept column that has one of these two names gives way to the result."""
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score")]
    picked = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    fields = [picked.schema[c] for c in keep]
    names = pa.schema([(c, pa.null()) for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return picked.mapInArrow(_judge(*model, names), f"{schema}, lang_pred string, score double")

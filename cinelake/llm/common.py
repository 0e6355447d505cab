"""What several operators share: columns of the input, words as hashes, bounded slices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import materialize
from cinelake.sources.readers import read_table

# Words whose hash a worker remembers; beyond it the memory is emptied, results stay.
REMEMBERED = 1 << 19


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, f"{directory}/documents.parquet")


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor``; NULL counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for NULL."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(texts: list, rows: int, size: int) -> Iterator[slice]:
    """Slices of at most ``rows`` texts and about ``size`` bytes; a larger text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        length = len(text) if text is not None else 0
        if i > start and (i - start >= rows or held + length > size):
            yield slice(start, i)
            start, held = i, 0
        held += length
    if start < len(texts):
        yield slice(start, len(texts))


class WordHashes(dict):
    """64-bit hashes of words, remembered in bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a well-known public hash)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` consecutive values."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = mixed(hashes[:count])
    for i in range(1, width):
        out = mixed(out + hashes[i : i + count])
    return out


def may_be_among(rows: DataFrame, keys: DataFrame, column: str, words: int | None = None) -> DataFrame:
    """Those of ``rows`` whose ``column`` may be among ``keys``: few others pass the filter, none of the
    keys' own is lost. It has ``words`` words of 64 bits (a power of two), or about one for two keys."""
    if words is None:
        words = 1 << min(20, max(12, (keys.count() // 2).bit_length()))
    hashed = lambda: F.xxhash64(column)
    word, bit = hashed().bitwiseAND(words - 1), F.shiftrightunsigned(hashed(), 40).bitwiseAND(63).cast("int")
    shifted = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)
    ones = keys.select(word.alias("word"), shifted(bit).alias("one")).groupBy("word").agg(F.bit_or("one").alias("ones"))
    held = rows.withColumn("word", word).join(F.broadcast(materialize(ones, "filter")), "word")
    return held.where(F.col("ones").bitwiseAND(shifted(bit)) != 0).drop("word", "ones")


def arrow_rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Columns of each batch as lists, texts as bytes."""
    for batch in batches:
        yield tuple(
            texts_of(batch.column(c)) if pa.types.is_string(batch.schema.field(c).type)
            or pa.types.is_large_string(batch.schema.field(c).type) else batch.column(c).to_pylist()
            for c in columns
        )

"""Exact all-pairs products of sparse vectors, block by block.

The vectors are hashed into shuffle blocks and every pair of blocks is one task; only
a small summary leaves the task (the best k per row, counts, or histogram bins),
never the pairs. A content seen by a third of the users therefore does not multiply
rows, as it would in a self-join on that content. A block is as large as a task's
memory allows, so that a cell is copied as seldom as possible (once per block), but
there are at least as many pairs of blocks as cores.

Inside a task the rows of each block are sorted by the group of features they lean to
and cut into tiles, and tiles are multiplied: densely, or, when few cells have a
feature in common, by a sum over just those. A tile keeps, per group of features, the
largest length of its rows within the group. The product of two tiles' lengths, summed
over the groups, bounds every cosine between them; when all rows of both already have
k better ones, the pair of tiles is skipped. Work is quadratic in the number of
vectors otherwise, as the full similarity matrix is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinelake.operators.matrix import DIGITS
from cinelake.session import cores, materialize

ROWS_PER_BLOCK = 65_536
CELLS_PER_BLOCK = 2_000_000
ROWS_PER_TILE = 1024
GROUPS = 32  # of features, hashed, for the bounds
FEATURES_PER_STEP = 2048
PRODUCTS_PER_STEP = 4_000_000

# Blocks a task reads of either side, some 150 MB, and cells of two blocks that may stay written out.
BLOCKS_PER_STRETCH = 4
DENSE_CELLS = 12_000_000

# Stands for a missing key, which sorts first.
NO_KEY = np.iinfo(np.int64).min

# What one product of two sparse cells costs, in multiply-adds of a dense matrix product.
SPARSE_COST = 100


def blocks_for(count: int, per_block: int) -> int:
    return max(1, math.ceil(count / per_block))


def row_blocks_for(rows: int, cell_count: int, tasks: int) -> int:
    """Blocks that bound both the rows and the cells a task holds, and whose pairs are at
    least ``tasks`` as long as there are rows enough. A cell is copied once per block."""
    busy = math.ceil((math.sqrt(8 * tasks + 1) - 1) / 2)
    by_size = max(blocks_for(rows, ROWS_PER_BLOCK), blocks_for(cell_count, CELLS_PER_BLOCK))
    return max(by_size, min(busy, max(rows, 1)))


def _bucket(column: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")


MAX_TASKS = 100_000


def block_pairs(df: DataFrame, key: str, blocks: int, *also: str, slices: int = 1) -> DataFrame:
    """Copy each row to every pair of blocks that its key takes part in, and bring the
    rows of a pair together. ``also`` names a further block column with ``slices`` values."""
    own = F.col("_block")
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")),
    )
    tasks = min(blocks * (blocks + 1) // 2 * slices, MAX_TASKS)
    return (
        df.withColumn("_block", _bucket(F.col(key), blocks))
        .withColumn("_pair", F.explode(pairs))
        .select("*", F.col("_pair.lo").alias("_lo"), F.col("_pair.hi").alias("_hi"))
        .drop("_pair")
        .repartition(tasks, "_lo", "_hi", *also)
    )


def unit_rows(cells: DataFrame, row: str, feature: str, value: str) -> DataFrame:
    """Scale each row vector to length 1, as (row, feature, value).

    The window spans one vector, which is at most as long as the feature list.
    """
    norm = F.sqrt(F.sum(F.col(value) * F.col(value)).over(W.partitionBy(row)))
    return cells.select(
        F.col(row).alias("row"), F.col(feature).alias("feature"), (F.col(value) / norm).alias("value")
    )


def _coded(frame: pd.DataFrame, shared: np.ndarray):
    """A block's keys in ascending order, and its cells on the shared features as
    (feature number, row number, value) sorted by feature."""
    keys, row = np.unique(frame["row"].to_numpy(), return_inverse=True)
    feature = frame["feature"].to_numpy()
    at = np.minimum(np.searchsorted(shared, feature), max(len(shared) - 1, 0))
    known = np.flatnonzero(shared[at] == feature) if len(shared) else np.empty(0, dtype=int)
    order = known[np.argsort(at[known], kind="stable")]
    return keys, at[order], row[order], frame["value"].to_numpy()[order]


def _dense_product(left, right, features: int) -> np.ndarray:
    """Product over stretches of features, each written out as two small matrices."""
    out = np.zeros((len(left[0]), len(right[0])))
    for start in range(0, features, FEATURES_PER_STEP):
        width = min(FEATURES_PER_STEP, features - start)

        def stretch(keys, at, row, value):
            a, b = np.searchsorted(at, [start, start + width])
            part = np.zeros((len(keys), width))
            part[row[a:b], at[a:b] - start] = value[a:b]
            return part

        out += stretch(*left) @ stretch(*right).T
    return out


def _sparse_product(left, right, first: np.ndarray, matches: np.ndarray) -> np.ndarray:
    """Product that visits only cells with a common feature, a bounded number at a time.

    ``first`` and ``matches`` tell, for each left cell, where the right cells of
    its feature start and how many there are.
    """
    rows, columns = len(left[0]), len(right[0])
    out = np.zeros(rows * columns)
    done = np.concatenate([[0], np.cumsum(matches)])
    a = 0
    while a < len(matches):
        b = max(a + 1, int(np.searchsorted(done, done[a] + PRODUCTS_PER_STEP, side="right")) - 1)
        count = matches[a:b]
        mine = np.repeat(np.arange(a, b), count)
        theirs = np.arange(done[b] - done[a]) + np.repeat(first[a:b] - (done[a:b] - done[a]), count)
        place = left[2][mine] * columns + right[2][theirs]
        out += np.bincount(place, weights=left[3][mine] * right[3][theirs], minlength=rows * columns)
        a = b
    return out.reshape(rows, columns)


class _Tile:
    """Rows of a block, keys ascending, and the bound of each feature group."""

    def __init__(self, coded, rows: np.ndarray, lengths: np.ndarray):
        keys, at, row, value = coded
        self.rows = np.sort(rows)
        place = np.full(len(keys), -1)
        place[self.rows] = np.arange(len(rows))
        own = place[row] >= 0
        self.cells = (keys[self.rows], at[own], place[row[own]], value[own])
        self.bounds = lengths[self.rows].max(axis=0, initial=0.0)


def _tiles(coded, groups: np.ndarray) -> list[_Tile]:
    """Tiles of rows that lean to the same features; ``groups`` is the group of each shared feature."""
    keys, at, row, value = coded
    squares = np.bincount(row * GROUPS + groups[at], weights=value * value, minlength=len(keys) * GROUPS)
    lengths = np.sqrt(squares.reshape(len(keys), GROUPS))
    order = np.argsort(lengths.argmax(axis=1), kind="stable")
    return [_Tile(coded, order[i : i + ROWS_PER_TILE], lengths) for i in range(0, len(order), ROWS_PER_TILE)]


def _tile_product(left: _Tile, right: _Tile, features: int) -> np.ndarray:
    a, b = left.cells, right.cells
    first = np.searchsorted(b[1], a[1], side="left")
    matches = np.searchsorted(b[1], a[1], side="right") - first
    if matches.sum() * SPARSE_COST < len(a[0]) * len(b[0]) * features:
        return _sparse_product(a, b, first, matches)
    return _dense_product(a, b, features)


def _tiled_sides(part: pd.DataFrame, lo: int, hi: int):
    """Tiles of both blocks, the same list for a block with itself, and the number of shared features."""
    left_part = part[part["_block"] == lo]
    right_part = left_part if lo == hi else part[part["_block"] == hi]
    shared = np.intersect1d(left_part["feature"].to_numpy(), right_part["feature"].to_numpy())
    groups = np.arange(len(shared)) * 2654435761 % 2**32 * GROUPS >> 32
    left = _tiles(_coded(left_part, shared), groups)
    return left, left if lo == hi else _tiles(_coded(right_part, shared), groups), len(shared)


def _products(part: pd.DataFrame, lo: int, hi: int, wanted=None):
    """(left tile, right tile, product) of every pair of tiles, each pair once; ``wanted`` may
    skip some. The closest pairs come first: a tile with itself, then by descending bound."""
    left, right, features = _tiled_sides(part, lo, hi)
    pairs = [(a, b) for i, a in enumerate(left) for b in (left[i:] if left is right else right)]
    for a, b in sorted(pairs, key=lambda p: (p[0] is not p[1], -float(p[0].bounds @ p[1].bounds))):
        if wanted is None or wanted(a, b):
            yield a, b, _tile_product(a, b, features)


def _cosine(product: np.ndarray) -> np.ndarray:
    return np.round(np.clip(product, -1.0, 1.0), DIGITS)


class _Block:
    """Rows of a block in tiles. ``keys`` are in the order of the tiles, ``features`` ascending; a cell is a
    place among the features, one among the keys, and its value, sorted by tile and feature."""

    NAMES = ("keys", "features", "at", "row", "value")
    TYPES = (np.int64, np.int64, np.int32, np.int32, np.float64)

    def __init__(self, *arrays: np.ndarray):
        self.keys, self.features, self.at, self.row, self.value = arrays

    @classmethod
    def of(cls, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> _Block:
        keys, row = np.unique(row, return_inverse=True)
        features, at = np.unique(feature, return_inverse=True)
        groups = _group(features)
        squares = np.bincount(row * GROUPS + groups[at], weights=value * value, minlength=len(keys) * GROUPS)
        order = np.argsort(squares.reshape(len(keys), GROUPS).argmax(axis=1), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        row = place[row]
        by = np.lexsort((at, row // ROWS_PER_TILE))
        return cls(*(x.astype(t) for x, t in zip((keys[order], features, at[by], row[by], value[by]), cls.TYPES)))

    def bytes(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.NAMES}

    @classmethod
    def read(cls, buffers) -> _Block:
        return cls(*(np.frombuffer(x, t) for x, t in zip(buffers, cls.TYPES)))

    def tiles(self, shared: np.ndarray) -> list[_Slice]:
        """The tiles, with their cells on the ``shared`` features only."""
        to = np.full(max(len(self.features), 1), -1, np.int32)
        to[np.searchsorted(self.features, shared)] = np.arange(len(shared), dtype=np.int32)
        at = to[self.at]
        row, value = self.row, self.value
        if len(shared) < len(self.features):
            known = np.flatnonzero(at >= 0)
            at, row, value = at[known], row[known], value[known]
        starts = np.arange(0, len(self.keys), ROWS_PER_TILE)
        ends = np.searchsorted(row // ROWS_PER_TILE, np.arange(len(starts) + 1))
        groups = _group(shared)
        return [
            _Slice(a, self.keys[a : a + ROWS_PER_TILE], at[i:j], row[i:j] - a, value[i:j], groups)
            for a, i, j in zip(starts, ends[:-1], ends[1:])
        ]


def _group(features: np.ndarray) -> np.ndarray:
    mixed = features.astype(np.int64).view(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
    return (mixed * np.uint64(GROUPS) >> np.uint64(32)).astype(np.int64)


class _Slice:
    """A tile of a block: ``start`` is the place of its first row in the block."""

    def __init__(self, start: int, keys, at, row, value, groups):
        self.start, self.cells, self.dense = start, (keys, at, row, value), None
        squares = np.bincount(row * GROUPS + groups[at], weights=value * value, minlength=len(keys) * GROUPS)
        self.bounds = np.sqrt(squares.reshape(len(keys), GROUPS).max(axis=0, initial=0.0))
        self.counts = np.bincount(at, minlength=len(groups)).astype(np.float64)

    def matrix(self, features: int) -> np.ndarray:
        if self.dense is None:
            keys, at, row, value = self.cells
            self.dense = np.zeros((len(keys), features))
            self.dense[row, at] = value
        return self.dense


def _slice_product(left: _Slice, right: _Slice, features: int, room: np.ndarray | None) -> np.ndarray | None:
    """None when no feature is in common. Written-out tiles stay in memory where there is ``room`` for
    their product, which is used again for the next one."""
    a, b = left.cells, right.cells
    matches = float(left.counts @ right.counts)
    if not matches:
        return None
    if matches * SPARSE_COST < len(a[0]) * len(b[0]) * features:
        first = np.searchsorted(b[1], a[1], side="left")
        return _sparse_product(a, b, first, np.searchsorted(b[1], a[1], side="right") - first)
    if room is not None:
        return np.matmul(left.matrix(features), right.matrix(features).T, out=room[: len(a[0]), : len(b[0])])
    return _dense_product(a, b, features)


def _true_places(found: np.ndarray) -> np.ndarray:
    """Where a flag matrix is set, counted along its rows; words without a flag are passed over."""
    flat = found.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    word, byte = np.nonzero(flat.reshape(-1, 8)[words])
    return words[word] * 8 + byte


class _Best:
    """The k largest positive cosines of each row so far; among equals the lowest other key first."""

    def __init__(self, keys: np.ndarray, k: int):
        self.keys, self.k = keys, k
        self.others = np.full((len(keys), k), np.iinfo(np.int64).max)
        self.values = np.zeros((len(keys), k))
        self.waiting: list[tuple] = []
        self.count = 0

    def least(self, tile: _Slice) -> float:
        """A cosine below it changes none of the lists of the tile's rows."""
        return self.values[tile.start : tile.start + len(tile.cells[0]), -1].min(initial=1.0)

    def add(self, tile: _Slice, other_keys: np.ndarray, product: np.ndarray, axis: int = 0) -> None:
        """Take the products that may enter a list; ``product`` has the rows of the tile along ``axis``."""
        rows = slice(tile.start, tile.start + len(tile.cells[0]))
        worst = self.values[rows, -1]
        # a rounded cosine reaches the worst one of a list, or is above 0, only from here on
        lower = np.maximum(worst, 10**-DIGITS) - 0.6 * 10**-DIGITS
        found = product >= np.expand_dims(lower, 1 - axis)
        size, k = len(other_keys), self.k
        if size > k and np.count_nonzero(found) > 4 * k * len(lower):
            kth = np.partition(product, size - k, axis=1 - axis).take(size - k, axis=1 - axis)
            lower = np.maximum(lower, kth - 1.2 * 10**-DIGITS)
            found = product >= np.expand_dims(lower, 1 - axis)
        at = _true_places(found)
        places = np.divmod(at, product.shape[1])
        r, c = places[axis], places[1 - axis]
        values, others = _cosine(product[places]), other_keys[c]
        better = values > worst[r]
        better |= (values == worst[r]) & (values > 0) & (others < self.others[rows, -1][r])
        r = r[better]
        if len(r):
            self.waiting.append((r + tile.start, values[better], others[better]))
            self.count += len(r)
            if self.count > max(4 * ROWS_PER_TILE, len(self.keys) // 4):
                self.settle()

    def settle(self) -> None:
        """Enter what was taken into the lists."""
        if not self.waiting:
            return
        row, value, other = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.count = [], 0
        touched = np.unique(row)
        i, j = np.nonzero(self.values[touched] > 0)
        old = touched[i]
        value = np.concatenate([value, self.values[old, j]])
        other = np.concatenate([other, self.others[old, j]])
        row = np.concatenate([row, old])
        by = np.lexsort((other, -value, row))
        row, value, other = row[by], value[by], other[by]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        kept = rank < self.k
        self.values[row[kept], rank[kept]] = value[kept]
        self.others[row[kept], rank[kept]] = other[kept]

    def frame(self) -> pd.DataFrame:
        self.settle()
        kept = self.values > 0
        return pd.DataFrame(
            {"row": np.repeat(self.keys, kept.sum(axis=1)), "other": self.others[kept], "similarity": self.values[kept]}
        )

    def lists(self) -> pa.RecordBatch:
        """A row per key that has any, with its list of (down, other)."""
        self.settle()
        kept = self.values > 0
        count = kept.sum(axis=1)
        have = count > 0
        near = pa.StructArray.from_arrays([pa.array(-self.values[kept]), pa.array(self.others[kept])], ["down", "other"])
        ends = np.r_[0, np.cumsum(count[have])].astype(np.int32)
        keys = self.keys[have]
        return pa.record_batch(
            {"row": pa.array(keys, mask=keys == NO_KEY), "near": pa.ListArray.from_arrays(pa.array(ends), near)}
        )


def best_of_pair(left: _Block, right: _Block, mine: _Best, theirs: _Best) -> int:
    """Take the cosines between two blocks, or within one, into the lists of both; tells how many
    pairs of tiles were skipped. The closest tiles come first: a tile with itself, then by descending bound."""
    same = left is right
    shared = left.features if same else np.intersect1d(left.features, right.features, assume_unique=True)
    small = (len(left.keys) + len(right.keys)) * len(shared) <= DENSE_CELLS
    room = np.empty((ROWS_PER_TILE, ROWS_PER_TILE)) if small else None
    tiles = left.tiles(shared)
    others = tiles if same else right.tiles(shared)
    reach = np.array([t.bounds for t in tiles]).reshape(-1, GROUPS) @ np.array([t.bounds for t in others]).reshape(-1, GROUPS).T
    skipped = 0
    pairs = [(i, j) for i in range(len(tiles)) for j in range(i if same else 0, len(others))]
    for i, j in sorted(pairs, key=lambda p: (not same or p[0] != p[1], -reach[p])):
        a, b = tiles[i], others[j]
        most = reach[i, j] + 10**-DIGITS
        if most < min(mine.least(a), theirs.least(b)) or most <= 2 * 10**-DIGITS:
            skipped += 1
            continue
        product = _slice_product(a, b, len(shared), room)
        if product is None:
            continue
        if a is b:
            np.fill_diagonal(product, 0.0)
        mine.add(a, b.cells[0], product)
        if a is not b:
            theirs.add(b, a.cells[0], product, axis=1)
    return skipped


def best_of_blocks(part: pd.DataFrame, lo: int, hi: int, k: int) -> tuple[pd.DataFrame, int]:
    """The k largest positive cosines per row between two blocks, and how many pairs of tiles were skipped."""
    blocks = {
        n: _Block.of(*(part.loc[part["_block"] == n, c].to_numpy() for c in ("row", "feature", "value"))) for n in {lo, hi}
    }
    best = {n: _Best(block.keys, k) for n, block in blocks.items()}
    skipped = best_of_pair(blocks[lo], blocks[hi], best[lo], best[hi])
    return pd.concat([b.frame() for b in best.values()]), skipped


def _pack(table: pa.Table) -> pa.Table:
    row = table["row"].combine_chunks().fill_null(NO_KEY)
    block = _Block.of(*(x.to_numpy() for x in (row, table["feature"], table["value"])))
    packed = {"block": table["_block"].combine_chunks()[:1]}
    packed |= {name: pa.array([x], pa.binary()) for name, x in block.bytes().items()}
    return pa.table(packed)


def _best_of_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The lists of all blocks of a task."""
    held, pairs = held_blocks(batches, _Block.NAMES, _Block.read)
    best = {n: _Best(block.keys, k) for n, block in held.items()}
    for a, b in pairs:
        best_of_pair(held[a], held[b], best[a], best[b])
    for found in best.values():
        yield found.lists()


def dealt(blocks: int, most: int, tasks: int) -> tuple[int, int]:
    """(stretches, blocks), at least as many blocks as given: so many stretches of blocks that their
    pairs keep ``tasks`` cores busy and none has over ``most`` blocks."""
    busy = math.ceil((math.sqrt(8 * 3 * tasks + 1) - 1) / 2)
    stretches = max(blocks_for(blocks, most), min(blocks, busy))
    return stretches, stretches * blocks_for(blocks, stretches)


def busy_blocks(by_size: int, rows: int, least: int, tasks: int) -> int:
    """More blocks than ``by_size`` when the cores would wait else, of ``least`` rows each."""
    return max(by_size, min(math.ceil((math.sqrt(8 * 3 * tasks + 1) - 1) / 2), blocks_for(rows, least)))


def stretch_pairs(packed: DataFrame, stretches: int, blocks: int) -> DataFrame:
    """The packed blocks of two stretches ``lo`` and ``hi`` in a partition of their own, for every pair of
    stretches. A block is copied once per stretch."""
    own = F.floor(F.col("block") * F.lit(stretches) / F.lit(blocks)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(stretches - 1)),
        lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")),
    )
    number = (F.col("hi") * (F.col("hi") + 1) / 2 + F.col("lo")).cast("int")
    return (
        packed.select("*", own.alias("stretch"), F.inline(pairs))
        .repartitionById(stretches * (stretches + 1) // 2, number)
    )


def held_blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str], read: Callable) -> tuple[dict, list]:
    """The blocks in a partition of ``stretch_pairs`` by number, and their pairs, each once."""
    held, stretch, ends = {}, {}, (0, 0)
    for batch in batches:
        for n in range(batch.num_rows):
            block = batch["block"][n].as_py()
            stretch[block], ends = batch["stretch"][n].as_py(), (batch["lo"][n].as_py(), batch["hi"][n].as_py())
            held[block] = read([batch[c][n].as_py() for c in names])
    return held, [(a, b) for a in sorted(held) for b in sorted(held) if a <= b and (stretch[a], stretch[b]) == ends]


def top_positive(units: DataFrame, rows: int, cell_count: int, k: int) -> DataFrame:
    """For every row vector the k others with the largest positive cosine, as
    (row, other, similarity); ties go to the lowest key.

    Blocks are packed and stored; a task reads two stretches of blocks, so that a block is copied
    once per stretch, and sends on one list per row for all of them.
    """
    tasks = cores(units.sparkSession)
    blocks = busy_blocks(row_blocks_for(rows, cell_count, tasks), rows, ROWS_PER_TILE, tasks)
    stretches, blocks = dealt(blocks, BLOCKS_PER_STRETCH, tasks)
    packed = materialize(
        units.select("row", "feature", F.col("value").cast("double").alias("value"))
        .withColumn("_block", _bucket(F.col("row"), blocks))
        .repartition(min(blocks, MAX_TASKS), "_block")
        .groupBy("_block")
        .applyInArrow(_pack, "block INT, " + ", ".join(f"{name} BINARY" for name in _Block.NAMES)),
        "blocks",
    )
    near = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return (
        stretch_pairs(packed, stretches, blocks)
        .mapInArrow(lambda batches: _best_of_batches(batches, k), "row BIGINT, near ARRAY<STRUCT<down: DOUBLE, other: BIGINT>>")
        .groupBy("row")
        .agg(near.alias("near"))
        .select("row", F.explode("near").alias("n"))
        .select("row", F.col("n.other").alias("other"), (-F.col("n.down")).alias("similarity"))
    )


def _pair_values(cosines: np.ndarray, same: bool) -> np.ndarray:
    return cosines[np.triu_indices(len(cosines), k=1)] if same else cosines.ravel()


def pair_statistics(units: DataFrame, rows: int, cell_count: int) -> DataFrame:
    """Count, mean, population deviation, least and largest cosine over all pairs of
    ``rows`` vectors. Vectors without a cell take part with cosine 0."""

    def task(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for a, b, product in _products(part, *key):
            values = _pair_values(_cosine(product), a is b)
            if len(values):
                found.append((len(values), values.sum(), (values * values).sum(), values.min(), values.max()))
        return pd.DataFrame(found, columns=["n", "s", "q", "lo", "hi"])

    parts = (
        block_pairs(units, "row", row_blocks_for(rows, cell_count, cores(units.sparkSession)))
        .groupBy("_lo", "_hi")
        .applyInPandas(task, "n BIGINT, s DOUBLE, q DOUBLE, lo DOUBLE, hi DOUBLE")
    )
    return summarize_pairs(parts, rows)


def summarize_pairs(parts: DataFrame, rows: int) -> DataFrame:
    """Combine partial sums (n, s, q, lo, hi) into statistics over all pairs of
    ``rows`` vectors; pairs that no part counted are zeros."""
    pairs = rows * (rows - 1) // 2
    if pairs == 0:
        zero = F.lit(0.0)
        return parts.agg(
            F.lit(0).cast("bigint").alias("Pairs"),
            zero.alias("Mean"),
            zero.alias("Std"),
            zero.alias("Min"),
            zero.alias("Max"),
        )
    summed = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum("q"), F.lit(0.0)).alias("q"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    zero_left = F.when(F.col("n") < pairs, F.lit(0.0))
    mean = F.col("s") / pairs
    return summed.select(
        F.lit(pairs).cast("bigint").alias("Pairs"),
        F.round(mean, 6).alias("Mean"),
        F.round(F.sqrt(F.greatest(F.col("q") / pairs - mean * mean, F.lit(0.0))), 6).alias("Std"),
        F.least("lo", zero_left).alias("Min"),
        F.greatest("hi", zero_left).alias("Max"),
    )


def pair_list_statistics(pairs: DataFrame, rows: int) -> DataFrame:
    """The same statistics for a list of non-zero pairs with a ``similarity``."""
    s = F.col("similarity")
    parts = pairs.agg(
        F.count("*").alias("n"),
        F.sum(s).alias("s"),
        F.sum(s * s).alias("q"),
        F.min(s).alias("lo"),
        F.max(s).alias("hi"),
    )
    return summarize_pairs(parts, rows)


def bin_index(value: Column, low: float, high: float, bins: int) -> Column:
    """Number of the equal-width bin; the last one includes its upper end."""
    if high == low:
        return F.when(value == low, F.lit(bins // 2)).cast("int")
    return F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")


def pair_histogram(units: DataFrame, rows: int, cell_count: int, bins: int) -> DataFrame:
    """Equal-width histogram of the cosine over all pairs of ``rows`` vectors, between
    the least and the largest cosine, as (Bin, Pairs)."""
    found = pair_statistics(units, rows, cell_count).first()
    low, high = found["Min"], found["Max"]

    def task(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(bins, np.int64)
        for a, b, product in _products(part, *key):
            values = _pair_values(_cosine(product), a is b)
            if high == low:
                counts[bins // 2] += len(values)
            else:
                at = np.minimum(np.floor((values - low) / (high - low) * bins), bins - 1)
                counts += np.bincount(at.astype(np.int64), minlength=bins)
        kept = np.flatnonzero(counts)
        return pd.DataFrame({"Bin": kept.astype("int32"), "Pairs": counts[kept]})

    counted = (
        block_pairs(units, "row", row_blocks_for(rows, cell_count, cores(units.sparkSession)))
        .groupBy("_lo", "_hi")
        .applyInPandas(task, "Bin INT, Pairs BIGINT")
        .groupBy("Bin")
        .agg(F.sum("Pairs").alias("Pairs"))
    )
    return with_zero_pairs(counted, rows, low, high, bins)


def pair_list_histogram(pairs: DataFrame, rows: int, bins: int) -> DataFrame:
    found = pair_list_statistics(pairs, rows).first()
    low, high = found["Min"], found["Max"]
    counted = pairs.groupBy(bin_index(F.col("similarity"), low, high, bins).alias("Bin")).agg(
        F.count("*").alias("Pairs")
    )
    return with_zero_pairs(counted, rows, low, high, bins)


def with_zero_pairs(counted: DataFrame, rows: int, low: float, high: float, bins: int) -> DataFrame:
    """Put the pairs that were not counted, all zeros, into their bin and add empty bins."""
    spark = counted.sparkSession
    missing = F.lit(rows * (rows - 1) // 2) - F.coalesce(F.sum("Pairs"), F.lit(0))
    zeros = counted.agg(missing.alias("Pairs")).select(
        bin_index(F.lit(0.0), low, high, bins).alias("Bin"), "Pairs"
    )
    empty = spark.range(bins).select(F.col("id").cast("int").alias("Bin"), F.lit(0).cast("bigint").alias("Pairs"))
    return (
        counted.unionByName(zeros.filter(F.col("Pairs") > 0))
        .unionByName(empty)
        .groupBy("Bin")
        .agg(F.sum("Pairs").alias("Pairs"))
        .orderBy("Bin")
    )


def gram(cells: DataFrame, row: str, feature: str, value: str, rows: int, cell_count: int) -> DataFrame:
    """Dot products of all row vectors that share a feature, as (a, b, dot), a <= b.

    For few rows over very many features: the features are hashed into blocks
    too, so that a row with a third of all cells is spread over the tasks; each
    task gives partial products and these are summed.
    """
    row_blocks = blocks_for(rows, ROWS_PER_TILE)
    pairs = row_blocks * (row_blocks + 1) // 2
    feature_blocks = max(
        blocks_for(2 * cell_count, CELLS_PER_BLOCK * row_blocks), blocks_for(cores(cells.sparkSession), pairs)
    )

    def task(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for left, right, product in _products(part, key[0], key[1]):
            if left is right:
                product = np.triu(product)
            a, b = np.nonzero(product)
            ends = np.sort([left.cells[0][a], right.cells[0][b]], axis=0)
            found.append((ends, product[a, b]))
        return pd.DataFrame(
            {
                "a": np.concatenate([np.empty(0, np.int64), *[f[0][0] for f in found]]),
                "b": np.concatenate([np.empty(0, np.int64), *[f[0][1] for f in found]]),
                "part": np.concatenate([np.empty(0), *[f[1] for f in found]]),
            }
        )

    vectors = cells.select(
        F.col(row).alias("row"), F.col(feature).alias("feature"), F.col(value).alias("value")
    ).withColumn("_feature_block", _bucket(F.col("feature"), feature_blocks))
    return (
        block_pairs(vectors, "row", row_blocks, "_feature_block", slices=feature_blocks)
        .groupBy("_lo", "_hi", "_feature_block")
        .applyInPandas(task, "a BIGINT, b BIGINT, part DOUBLE")
        .groupBy("a", "b")
        .agg(F.sum("part").alias("dot"))
    )


def cosine_pairs(dots: DataFrame) -> DataFrame:
    """Cosine of each pair a < b out of the dot products, as (a, b, similarity)."""
    norms = dots.filter(F.col("a") == F.col("b")).select(F.col("a").alias("key"), F.col("dot").alias("square"))
    left = norms.select(F.col("key").alias("a"), F.col("square").alias("_sa"))
    right = norms.select(F.col("key").alias("b"), F.col("square").alias("_sb"))
    cosine = F.col("dot") / F.sqrt(F.col("_sa") * F.col("_sb"))
    return (
        dots.filter(F.col("a") < F.col("b"))
        .join(left, "a")
        .join(right, "b")
        .select(
            "a",
            "b",
            F.round(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)), DIGITS).alias("similarity"),
        )
        .filter(F.col("similarity") != 0)
    )

"""An FM-index over words: suffix order, wavelet-matrix ranks, sampled suffix positions.

The text is an array of symbols, 0 being a terminator. Every terminator counts as a
symbol of its own (ordered by place), so suffixes differ at the next one at the latest.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling over the undecided ones only."""
    count = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    rank = np.empty(count, np.int64)
    rank[order] = np.searchsorted(ordered, ordered, "left")
    zeros = int(np.searchsorted(ordered, 0, "right"))
    rank[order[:zeros]] = np.arange(zeros)
    open_ = np.flatnonzero(np.bincount(rank, minlength=count)[rank] > 1)
    step = 1
    while len(open_):
        key = rank[open_] << 32 | rank[open_ + step]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        group = np.r_[True, (key[1:] >> 32) != (key[:-1] >> 32)]
        fresh = np.r_[True, key[1:] != key[:-1]]
        index = np.arange(len(key))
        group_start = np.maximum.accumulate(np.where(group, index, 0))
        fresh_start = np.maximum.accumulate(np.where(fresh, index, 0))
        rank[open_] += fresh_start - group_start
        sizes = np.diff(np.r_[np.flatnonzero(fresh), len(key)])
        open_ = open_[np.repeat(sizes > 1, sizes)]
        step *= 2
    order[rank] = np.arange(count)
    return order


class Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        rest = symbols.astype(np.uint32)
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (rest >> np.uint32(shift) & np.uint32(1)).astype(bool)
            self.levels.append((shift, Bits(bits), len(bits) - int(bits.sum())))
            rest = np.concatenate([rest[~bits], rest[bits]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``place``."""
        start = np.zeros_like(place)
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            before, first = bits.ones(place), bits.ones(start)
            place = np.where(one, zeros + before, place - before)
            start = np.where(one, zeros + first, start - first)
        return place - start

    def read(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at ``place`` and how often it occurs before."""
        symbol, start = np.zeros_like(place), np.zeros_like(place)
        for _, bits, zeros in self.levels:
            one = bits.at(place)
            symbol = symbol << 1 | one
            before, first = bits.ones(place), bits.ones(start)
            place = np.where(one, zeros + before, place - before)
            start = np.where(one, zeros + first, start - first)
        return symbol, place - start


class FMIndex:
    """Index of one shard. ``symbols`` ends with a terminator; ``largest`` is the highest symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        order = suffix_order(symbols)
        previous = symbols[order - 1]
        self.matrix = WaveletMatrix(previous, largest)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=largest + 1))]
        # a walk back never has to pass a terminator, whose order the ranks do not tell
        sampled = (order % SAMPLE == 0) | (previous == 0)
        self.sampled, self.places = Bits(sampled), order[sampled]
        self.count = len(symbols)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all phrases (padded rows of symbols), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.count, np.int64)
        for at in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((at < lengths) & (low < high))
            if len(live):
                symbol = phrases[live, at]
                low[live] = self.smaller[symbol] + self.matrix.rank(symbol, low[live])
                high[live] = self.smaller[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows, walking back to the next sampled one."""
        places, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        rows = rows.copy()
        while len(live):
            hit = self.sampled.at(rows[live])
            found = live[hit]
            places[found] = self.places[self.sampled.ones(rows[found])] + steps[found]
            live = live[~hit]
            symbol, before = self.matrix.read(rows[live])
            rows[live] = self.smaller[symbol] + before
            steps[live] += 1
        return places

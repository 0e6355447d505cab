"""Best-fit packing of token sequences by hierarchical residual packing.

Pieces are packed best-fit, largest first, inside each partition. Bins that are full
up to ``slack`` leave; the others go on as items, are merged into fewer partitions and
packed again, until one bounded partition is left or nothing more can be merged. A bin
carries its members (at most ``size``, as each has a token), so no round joins.

A NULL text is an empty document: its end token alone. Every document has at least one
piece. Repeated rows are packed as often as they occur, ties in the order they come. A very
long text is encoded in slices cut at white space. An empty table gives no rows. Only the id
and ``text`` are read, whatever type the id has; other columns may have any name.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import REMEMBERED, mixed, slices, texts_of
from cinelake.session import materialize

SIZE = 2048
# Rows of one packing task; a round has at least as many partitions as that needs.
TASK_BINS = 100_000
# Fewer rows than this are not dealt out further: larger tasks leave fewer bins underfull.
LEAST_BINS = 4_000
ROUNDS = 4

_SLICE = 256 << 10  # bytes of text encoded at once
_PIECE = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


# Kinds of bytes: blanks part chunks, letters and marks are pre-tokens of their own, a
# chunk with anything else (digits, apostrophes, other scripts) is encoded as it stands.
_BLANK, _LETTER, _MARK, _OTHER = 0, 1, 2, 3
_BASE = 0x9E3779B97F4A7C15


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[list(b" \n")] = _BLANK
    kinds[33:127] = _MARK
    kinds[48:58] = kinds[ord("'")] = _OTHER
    kinds[65:91] = kinds[97:123] = _LETTER
    return kinds


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(
        np.cumprod(np.r_[np.uint64(1), np.full(count, base, np.uint64)], dtype=np.uint64) for base in (_BASE, inverse)
    )


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the stretches that begin at ``starts``, in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _cut_at_blanks(text: bytes) -> Iterator[bytes]:
    """The text in slices of about ``_SLICE`` bytes. A slice without a blank goes on to the next one."""
    blank, at = re.compile(rb"[ \n]"), 0
    while len(text) - at > _SLICE:
        found = blank.search(text, at + _SLICE)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class TextIds:
    """Ids of texts, with a bounded memory of the pre-tokens met.

    The tokenizer drops white space, never joins over it, and parts letters from marks,
    so a text's ids are those of its runs of letters (in lower case) and of marks. Runs
    are found and hashed for a slice of texts at once; only runs not met before are
    encoded, many in one call, and parted at the tokens that end a word. A text that
    holds an added token, such as a literal end mark, is encoded whole instead.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and threads keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.kinds = _kinds()
        self.powers = _powers(2 * _SLICE)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # sorted; of each, where its ids lie in the pool
        self.first = self.count = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)
        self.bytes_at = self.bytes_of = np.empty(0, np.int64)  # where the run's own bytes lie, and how many
        self.bytes = np.empty(0, np.uint8)

    def _learn(self, runs: list[str], single: bool) -> tuple[list[np.ndarray], list[int]]:
        """Ids of the runs in a row, and how many each has. ``single``: each is one pre-token."""
        ids, counts = [np.empty(0, np.uint32)], []
        if single:
            groups = [" ".join(runs[i : i + 500]) for i in range(0, len(runs), 500)]
            for found in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
                ids.append(np.array(found.ids, np.uint32))
                counts += np.diff(np.r_[-1, np.flatnonzero(self.ends[ids[-1]])]).tolist()
        else:
            for found in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False):
                ids.append(np.array(found.ids, np.uint32))
                counts.append(len(ids[-1]))
        if len(counts) != len(runs):
            raise ValueError("the tokenizer does not part words as expected")
        return ids, counts

    def _remember(self, raw: bytes, low: bytes, hashes, starts, stops, kinds) -> None:
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        fresh = np.flatnonzero(~known)
        plain = fresh[kinds[fresh] != _OTHER]
        other = fresh[kinds[fresh] == _OTHER]
        spans = lambda some, text: [
            text[a:b].decode("utf-8", "replace") for a, b in zip(starts[some].tolist(), stops[some].tolist())
        ]
        ids, counts = self._learn(spans(plain, low), True)
        more, most = self._learn(spans(other, raw), False)
        counts = np.array(counts + most, np.int64)
        first = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate([self.pool, *ids, *more])
        new = hashes[np.r_[plain, other]]
        order = np.argsort(new)
        place = np.searchsorted(self.hashes, new[order])
        self.hashes = np.insert(self.hashes, place, new[order])
        self.first = np.insert(self.first, place, first[order])
        self.count = np.insert(self.count, place, counts[order])
        some = np.r_[plain, other]
        sizes = stops[some] - starts[some]
        self.bytes_at = np.insert(self.bytes_at, place, (len(self.bytes) + np.cumsum(sizes) - sizes)[order])
        self.bytes_of = np.insert(self.bytes_of, place, sizes[order])
        self.bytes = np.r_[self.bytes, np.frombuffer(low, np.uint8)[_spread(starts[some], sizes)]]

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        whole = [any(token in text for token in self.added) for text in texts]
        out = self._of_runs([b"" if odd else text for text, odd in zip(texts, whole)])
        for at in np.flatnonzero(whole).tolist():
            out[at] = self._encoded(texts[at])
        return out

    def of_long(self, text: bytes) -> np.ndarray:
        """Ids of a text of any length, encoded in slices."""
        return np.concatenate([ids for part in _cut_at_blanks(text) for ids in self.of([part])])

    def _encoded(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def _of_runs(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = b"\n".join(texts) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        if len(data) >= len(self.powers[0]):
            self.powers = _powers(2 * len(data))
        kinds, low = self.kinds[data], data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # Latin letters
        kinds[lead] = kinds[lead + 1] = _LETTER
        capital = lead[data[lead + 1] < 0x9F] + 1
        low[capital] += 32
        chunk = np.cumsum(kinds == _BLANK)
        odd = np.zeros(chunk[-1] + 1, bool)
        odd[chunk[kinds == _OTHER]] = True
        kinds[odd[chunk] & (kinds != _BLANK)] = _OTHER
        edges = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
        starts, stops = edges, np.r_[edges[1:], len(data)]
        keep = kinds[starts] != _BLANK
        starts, stops = starts[keep], stops[keep]
        power, inverse = self.powers
        low[kinds == _OTHER] = data[kinds == _OTHER]
        sums = np.r_[np.uint64(0), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)])]
        hashes = mixed((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
        hashes[kinds[starts] == _OTHER] ^= np.uint64(_BASE)
        distinct, place, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED // 2:
            self._forget()
        self._remember(raw, low.tobytes(), distinct, starts[place], stops[place], kinds[starts[place]])
        at = np.searchsorted(self.hashes, distinct)[back]
        sizes = stops - starts
        if (self.bytes_of[at] != sizes).any() or (self.bytes[_spread(self.bytes_at[at], sizes)] != low[_spread(starts, sizes)]).any():
            return [self._encoded(text) for text in texts]  # different runs of one hash
        counts = self.count[at]
        edges = np.r_[0, np.cumsum(counts)]
        ids = self.pool[np.repeat(self.first[at] - edges[:-1], counts) + np.arange(edges[-1])]
        bounds = np.cumsum([len(t) + 1 for t in texts])
        cuts = edges[np.searchsorted(starts, bounds)]
        return np.split(ids, cuts[:-1])


def _pieces(path: str, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = TextIds(path), bytes(4)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for some in slices([range(size) for size in sizes], 1 << 30, _SLICE):
                texts = [text or b"" for text in texts_of(batch.column(1).slice(some.start, some.stop - some.start))]
                ids = [known.of_long(texts[0])] if len(texts) == 1 else known.of(texts)
                out: list[list] = [[] for _ in range(5)]
                for row, found in enumerate(ids, some.start):
                    found = found.astype("<u4").tobytes() + end
                    for number, at in enumerate(range(0, len(found), 4 * size)):
                        part = found[at : at + 4 * size]
                        for column, value in zip(out, (row, number, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(out[0], pa.int64()))] + [pa.array(c, t) for c, (_, t) in zip(out[1:], _PIECE)],
                    ["doc_id", *[name for name, _ in _PIECE]],
                )

    return run


def _fields(id_type: str) -> str:
    return f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, tokenizer: str, size: int = SIZE, id_column: str = "doc_id") -> DataFrame:
    """Pieces of at most ``size`` ids of every document, the end token 0 included."""
    picked = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = picked.mapInArrow(_pieces(tokenizer, size), _fields(picked.schema["doc_id"].dataType.simpleString()))
    return pieces.withColumnRenamed("doc_id", id_column)


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """Bin number of every item: largest first, each into the fullest bin that takes it."""
    bins = np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(size + 1)]
    open_rooms, count = 0, 0  # bit r: some bin has r tokens of room
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fitting = open_rooms >> need
        if fitting:
            left = need + (fitting & -fitting).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            left, number = size, count
            count += 1
        bins[item] = number
        if left > need:
            if not room[left - need]:
                open_rooms |= 1 << (left - need)
            room[left - need].append(number)
    return bins


def _pack(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]  # at most about TASK_BINS rows
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        used = table.column("used").to_numpy()
        bins = best_fit(used, size)
        order = np.argsort(bins, kind="stable")
        members = table.column("members").combine_chunks().take(pa.array(order))
        counts = np.diff(members.offsets.to_numpy())
        number = bins[order]
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        edges = np.r_[0, np.cumsum(counts)]
        offsets = np.r_[edges[starts], edges[-1]].astype(np.int32)
        packed = pa.ListArray.from_arrays(pa.array(offsets), members.flatten())
        sums = np.add.reduceat(used[order], starts)
        for at in range(0, len(sums), 4096):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums[at : at + 4096]), packed.slice(at, 4096)], ["used", "members"]
            )

    return run


def _laid(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per member of each bin, with its place there."""
    for batch in batches:
        members = batch.column(1)
        flat, counts = members.flatten(), np.diff(members.offsets.to_numpy())
        lengths = flat.field("length").to_numpy(zero_copy_only=False)
        before = np.cumsum(lengths) - lengths
        firsts = np.cumsum(counts) - counts  # no bin is empty
        offsets = before - np.repeat(before[firsts], counts)
        numbers = np.repeat(batch.column(0).to_numpy(), counts)
        names = [flat.type.field(i).name for i in range(flat.type.num_fields)]
        yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(numbers), pa.array(offsets)], [*names, "sequence_id", "offset"])


def pack(pieces: DataFrame, size: int = SIZE, slack: int = 4, label: str = "packing", id_column: str = "doc_id") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences hold at most ``size`` ids."""
    fields = _fields(pieces.schema[id_column].dataType.simpleString())
    items = pieces.select(
        F.col("length").alias("used"),
        F.array(F.struct(F.col(f"`{id_column}`").alias("doc_id"), "piece", "start", "length", "ids_crc32")).alias("members"),
    )
    schema = f"used long, members {items.schema['members'].dataType.simpleString()}"
    left = materialize(items, f"{label}-items")
    done: DataFrame | None = None
    count = left.count()
    tasks = 2 * pieces.sparkSession.sparkContext.defaultParallelism
    spread = max(-(-count // TASK_BINS), min(tasks, -(-count // LEAST_BINS)), 1)
    for turn in range(ROUNDS):
        dealt = left.repartition(spread) if spread > 1 else left.coalesce(1)
        packed = materialize(dealt.mapInArrow(_pack(size), schema), f"{label}-bins")
        full = packed.where(F.col("used") >= size - slack)
        done = full if done is None else done.unionByName(full)
        left = packed.where(F.col("used") < size - slack)
        count = left.count()
        if count <= 1 or spread == 1:
            break
        spread = max(-(-count // TASK_BINS), spread // 4 if turn < ROUNDS - 2 else 1, 1)
    bins = done.unionByName(left).select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    laid = bins.mapInArrow(_laid, f"{fields}, sequence_id long, offset long")
    return laid.withColumnRenamed("doc_id", id_column)

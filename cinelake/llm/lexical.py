"""Ranked lexical search: exact top-k inner products by norm buckets.

A document is a vector of whole-number impacts over the terms of the queries, a query one
of term weights times their number. Both are scaled by the square root of the weight, so
that a frequent term adds little to a vector's length; their inner product is the score.

Documents are range-sorted by length, longest first, and searched in buckets. For each
query the k-th best score so far is the threshold: a bucket whose longest vector cannot
reach it by Cauchy-Schwarz is skipped, and so is the rest of a bucket behind the last
vector that can. Inside, the query's largest coordinates are taken one by one: what is
known of the product plus the lengths of the unknown rests bounds it. Survivors are
rescored in 64-bit integers. Bounds are in doubles with a margin, and a vector goes only
when its bound is below the threshold, so ties and results are exact.

A first pass over the longest bucket of each stored partition gives all tasks a common
threshold. Queries are taken in blocks of bounded text, one at a time, whose vocabulary
and weights are broadcast; a document is split once per block and never leaves its row.
What a task sends on is k rows a query.

NULL and empty texts have no term: such documents are found by nothing and do not count,
such queries find nothing. Long texts are split in pieces between terms. Equal scores go
by ascending id, a NULL id last; a repeated document takes a rank for each row, a repeated
query is answered for each row. Empty tables give no rows. Only the id and ``text`` of both
tables are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.common import texts_of
from cinelake.llm.decontaminate import words_of
from cinelake.session import materialize

TOP = 10
BUCKET = 2048
FOCUS = 16  # coordinates looked at before a survivor is rescored
PART_BYTES = 4 << 20
_PIECE = 1 << 20
_INDEX = (1 << 33) - 1  # the part of a monotonically increasing id that counts within a partition
_MARGIN = 1 + 1e-9
_GAP = np.zeros(256, bool)
_GAP[[b for b in range(128) if not chr(b).isalnum()]] = True


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``_PIECE`` bytes, cut between terms."""
    data, at = np.frombuffer(text, np.uint8), 0
    while len(text) - at > _PIECE:
        stop = at + _PIECE
        while stop < len(text):
            gaps = np.flatnonzero(_GAP[data[stop : stop + _PIECE]])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop += _PIECE
        yield text[at:stop]
        at = stop
    yield text[at:]


class Queries:
    """A block of queries: their vocabulary, and term numbers with counts of each."""

    def __init__(self, rows: list[tuple[object, bytes | None]]):
        self.names = [name for name, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        for _, text in rows:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            terms, counts = np.unique(np.array(found, np.int64), return_counts=True)
            self.terms.append(terms)
            self.counts.append(counts.astype(np.int64))


def _vectors(queries):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = queries.value.vocabulary.get
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in texts_of(batch.column(1)):
                total, found = 0, []
                for piece in _pieces(text or b""):
                    words = words_of(piece)
                    total += len(words)
                    numbers = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    found.append(np.unique(numbers[numbers >= 0], return_counts=True))
                if len(found) > 1:
                    own, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    sums = np.bincount(back, np.concatenate([f[1] for f in found]), len(own)).astype(np.int64)
                    found = [(own, sums)]
                lengths.append(total)
                terms.append(found[0][0])
                counts.append(found[0][1])
            offsets = np.r_[0, np.cumsum([len(t) for t in terms])].astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, kind), *some]).astype(kind)))
                for some, kind in ((terms, np.int32), (counts, np.int64))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *lists], ["id", "n", "terms", "counts"]
            )

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    offsets = column.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64), column.flatten().to_numpy()


def _impacts(weights, documents: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, terms = _flat(batch.column(2))
            _, counts = _flat(batch.column(3))
            length = [25 + 75 * n * documents // words for n in batch.column(1).to_pylist()]
            m = np.repeat(np.array(length, np.int64), np.diff(offsets))
            impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m)
            squares = np.r_[0.0, np.cumsum(weights.value[terms] * impacts.astype(float) ** 2)]
            norms = np.sqrt(np.maximum(squares[offsets[1:]] - squares[offsets[:-1]], 0)) * _MARGIN + 1e-3
            made = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(impacts.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norms), batch.column(2), made], ["id", "norm", "terms", "impacts"]
            )

    return run


class _Bucket:
    """Documents of about one length, longest first, with their impacts by document and by term."""

    def __init__(self, ids: list, norms: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        order = np.argsort(-norms, kind="stable")
        sizes = np.diff(offsets)[order]
        edges = np.r_[0, np.cumsum(sizes)]
        pick = np.repeat(offsets[:-1][order] - edges[:-1], sizes) + np.arange(edges[-1])
        self.ids, self.norms, self.edges = [ids[i] for i in order.tolist()], norms[order], edges
        self.terms, self.impacts = terms[pick], impacts[pick].astype(np.int64)
        by_term = np.argsort(self.terms, kind="stable")
        self.sorted_terms, self.by_term = self.terms[by_term], by_term
        self.rows = np.repeat(np.arange(len(order)), sizes)

    def coordinate(self, term: int) -> np.ndarray:
        """The term's impact in every document."""
        low, high = np.searchsorted(self.sorted_terms, [term, term + 1])
        at, out = self.by_term[low:high], np.zeros(len(self.norms))
        out[self.rows[at]] = self.impacts[at]
        return out

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of the given documents; ``dense``: the query's weight of each term."""
        sizes = self.edges[rows + 1] - self.edges[rows]
        ends = np.cumsum(sizes)
        pick = np.repeat(self.edges[rows] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        sums = np.r_[0, np.cumsum(dense[self.terms[pick]] * self.impacts[pick])]
        return sums[ends] - sums[ends - sizes]


class Search:
    """Running top ``top`` of a block of queries over buckets of documents."""

    def __init__(self, queries: Queries, weights: np.ndarray, least: np.ndarray, top: int):
        self.queries, self.top = queries, top
        self.least = np.maximum(least, 1).astype(np.int64)  # of each query, the score to reach
        self.best: list[list[tuple]] = [[] for _ in queries.names]
        self.dense = np.zeros(len(weights), np.int64)
        self.exact = [weights[t] * c for t, c in zip(queries.terms, queries.counts)]
        self.roots = np.sqrt(weights.astype(float))
        scaled = [self.roots[t] * c for t, c in zip(queries.terms, queries.counts)]
        self.norms = np.array([math.sqrt(float((s * s).sum())) for s in scaled])
        self.focus = [np.argsort(-s, kind="stable")[:FOCUS] for s in scaled]
        self.scaled = scaled

    def _survivors(self, number: int, bucket: _Bucket) -> np.ndarray:
        least, norm = float(self.least[number]), self.norms[number]
        live = np.arange(int(np.searchsorted(-(bucket.norms * norm * _MARGIN), -least, "right")))
        known = np.zeros(len(live))
        rest, query_rest = bucket.norms[live] ** 2, norm * norm
        for at in self.focus[number].tolist():
            if not len(live):
                break
            own = self.scaled[number][at]
            term = int(self.queries.terms[number][at])
            value = self.roots[term] * bucket.coordinate(term)[live]
            known, rest = known + own * value, rest - value * value
            query_rest -= own * own
            bound = known + np.sqrt(max(query_rest, 0) * np.maximum(rest, 0)) + 1e-6 * norm
            keep = bound * _MARGIN >= least
            live, known, rest = live[keep], known[keep], rest[keep]
        return live

    def add(self, bucket: _Bucket) -> int:
        """Take a bucket in; how many documents were rescored."""
        rescored = 0
        for number in np.flatnonzero(self.norms * bucket.norms[0] * _MARGIN >= self.least).tolist():
            rows = self._survivors(number, bucket)
            if not len(rows):
                continue
            rescored += len(rows)
            terms = self.queries.terms[number]
            self.dense[terms] = self.exact[number]
            scores = bucket.scores(rows, self.dense)
            self.dense[terms] = 0
            good = scores >= self.least[number]
            if good.any():
                best = self.best[number]
                best += [
                    (-s, bucket.ids[r] is None, bucket.ids[r]) for s, r in zip(scores[good].tolist(), rows[good].tolist())
                ]
                if len(best) >= self.top:
                    best[:] = heapq.nsmallest(self.top, best)
                    self.least[number] = max(self.least[number], -best[-1][0])
        return rescored

    def found(self) -> Iterator[tuple[int, object, int]]:
        for number, best in enumerate(self.best):
            for score, _, name in best:
                yield number, name, -score


def _searched(queries, weights, least, top: int, id_type: pa.DataType, name_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            search = search or Search(queries.value, weights.value, least.value, top)
            for at in range(0, batch.num_rows, BUCKET):
                some = batch.slice(at, BUCKET)
                offsets, terms = _flat(some.column(2))
                _, impacts = _flat(some.column(3))
                search.add(_Bucket(some.column(0).to_pylist(), some.column(1).to_numpy(), offsets, terms, impacts))
        numbers, ids, scores = zip(*search.found()) if search and any(search.best) else ((), (), ())
        names = [queries.value.names[n] for n in numbers]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(names, name_type), pa.array(ids, id_type), pa.array(scores, pa.int64())],
            ["number", "name", "id", "score"],
        )

    return run


def _top(rows: DataFrame, top: int) -> DataFrame:
    """The best ``top`` rows of each query, ranked; Spark keeps as many of each task only."""
    best_first = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)


def _block(docs: DataFrame, queries: Queries, name_type, top: int) -> DataFrame:
    """(name, rank, id, score) for one block of queries."""
    from pyspark.sql.pandas.types import to_arrow_type

    context = docs.sparkSession.sparkContext
    asked = context.broadcast(queries)
    id_type = docs.schema["id"].dataType
    own = id_type.simpleString()
    vectors = materialize(
        docs.mapInArrow(_vectors(asked), f"id {own}, n long, terms array<int>, counts array<long>").where("n > 0"), "vectors"
    )
    total = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    frequency = np.zeros(len(queries.vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # of the block's vocabulary
        frequency[row.term] = row["count"]
    weights = [math.floor(1000 * math.log((2 * total.documents + 2) / (2 * df + 1))) for df in frequency.tolist()]
    weighed = context.broadcast(np.array(weights, np.int64))

    filled = vectors.where(F.size("terms") > 0).select("id", "n", "terms", "counts")
    impacts = materialize(
        filled.mapInArrow(
            _impacts(weighed, total.documents, total.words or 1), f"id {own}, norm double, terms array<int>, impacts array<int>"
        ),
        "impacts",
    )
    longest_first = [F.col("norm").desc(), F.xxhash64("id")]
    sorted_rows = impacts.repartitionByRange(*longest_first).sortWithinPartitions(*longest_first)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX))
    buckets = materialize(sorted_rows.withColumn("bucket", F.floor(place / BUCKET)), "norm-buckets")

    def searched(rows: DataFrame, least: np.ndarray) -> DataFrame:
        run = _searched(asked, weighed, context.broadcast(least), top, to_arrow_type(id_type), to_arrow_type(name_type))
        schema = f"number int, name {name_type.simpleString()}, id {own}, score long"
        return _top(rows.select("id", "norm", "terms", "impacts").mapInArrow(run, schema), top)

    least = np.zeros(len(queries.names), np.int64)
    seeds = searched(buckets.where("bucket = 0"), least).where(F.col("rank") == top)
    for row in seeds.select("number", "score").collect():  # a row per query of the block
        least[row.number] = row.score
    return materialize(searched(buckets, least).select("name", "rank", "id", "score"), "ranked")


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_column: str = "doc_id",
    query_column: str = "item_id",
    top: int = TOP,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(query id, rank, document id, score): the ``top`` documents of each row of ``queries``
    with a score above 0. Both tables have a column ``text``."""
    inner = docs.select(F.col(f"`{id_column}`").alias("id"), F.col("text").cast("string").alias("text"))
    asked = queries.select(F.col(f"`{query_column}`").alias("name"), F.col("text").cast("string").alias("text"))
    name_type = asked.schema["name"].dataType
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    found = None
    for number in range(parts):
        own = asked.where(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == number) if parts > 1 else asked
        rows = [(r.name, r.text.encode()) for r in own.where("text IS NOT NULL").select("name", "text").toLocalIterator()]
        block = _block(inner, Queries(rows), name_type, top)
        found = block if found is None else found.unionByName(block)
    return found.select(F.col("name").alias(query_column), "rank", F.col("id").alias(id_column), "score")

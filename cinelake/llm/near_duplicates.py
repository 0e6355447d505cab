"""MinHash near-duplicates by chosen-path set similarity join.

Documents with equal shingle sets are one class. Every class gets ``SKETCH`` minwise
tokens and ``BINS`` bytes, each a hash of the least shingle of one part of the hash range.
In each of ``trees`` independent trees the root branches by one token; a node
with more than ``SMALL`` classes branches again by tokens chosen from its own path, two
at a time, so that a similar pair goes on in at least one of them. The classes of a
small node are compared with each other: pairs whose bytes agree as often as
similar ones do (five deviations of slack) are confirmed on their full shingle sets.

A node that holds more than ``DENSE`` of its parent is not branched further: minwise tokens hardly part
it. Its most central class becomes the centre of a star, and the classes left in
another component than most of the node are compared with the whole node by tiles of at
most ``TILE`` classes a side. So rows grow by 2 x ``DENSE`` a level at most, a tree is as deep as
its nodes need, and no task sees a large node whole. The centre is chosen by a sample of the
node; it decides on the work only, never on the links.

Links are confirmed in two steps, as only components are asked for: first one candidate
of each class, then every candidate whose ends are still in different components. Candidates
of a tile are confirmed in the tile, where the texts of the classes concerned meet; a pair is tried in
one tile, that of the least dense node both classes are in, and a tile gives a spanning set of its links.

A pair at the threshold s survives a tree with at least s(1 - q), q = (1 - s(1 - q))^2 being
the chance that both branches of a node lose it, at any depth: 0.75 for 0.8, so ten trees
miss it with a chance of 1e-6.

NULL texts and texts without words have an empty set and link with nothing; a text of
fewer words than a shingle is one shingle. Repeated rows and ids are kept as they are. Very
long texts are cut into shingles whole. An empty table gives an empty result; other columns
of any name are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import namedtuple
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import WordHashes, may_be_among, mixed, texts_of, windows
from cinelake.llm.components import components
from cinelake.session import materialize, task_count

SKETCH, SMALL, TREES, DENSE = 64, 48, 10, 0.6
BINS, COARSE = 512, 64
TILE, REFERENCES = 4096, 32
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes | None, width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    hashes = known.of((text or b"").lower().split())
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(width, len(hashes))))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH`` minwise tokens of a set, as 32-bit numbers."""
    out = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        some = shingles[start : start + 4096]
        out = np.minimum(out, ((some ^ (some >> np.uint64(29))) * _SEEDS[:, None]).min(axis=1))
    return (mixed(out) >> np.uint64(32)).astype(np.uint32)


def bytes_of(shingles: np.ndarray) -> np.ndarray:
    """A byte for each of ``BINS`` parts of the hash range: 1 to 255 from the part's least
    shingle, 0 where the set has none there. ``shingles`` are sorted, so parts are runs."""
    parts = (shingles >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else parts
    out = np.zeros(BINS, np.uint8)
    out[parts[first]] = mixed(shingles[first]) % np.uint64(255) + np.uint64(1)
    return out


def alike(own: np.ndarray, others: np.ndarray, share: float) -> np.ndarray:
    """Numbers of the rows of ``others`` that agree with ``own`` as often as a set of similarity
    ``share`` does, less five deviations. Parts empty in both sets tell nothing and do not count."""
    # agreement of the first parts, empty ones included, can only be more than is needed
    least = COARSE * share - 5 * math.sqrt(COARSE * share * (1 - share))
    at = np.flatnonzero((others[:, :COARSE] == own[:COARSE]).sum(axis=1) >= least)
    if len(at):
        theirs = others[at]
        empty = (theirs[:, own == 0] == 0).sum(axis=1)
        told = BINS - empty
        agree = (theirs == own).sum(axis=1) - empty
        # the least shingles of the parts are a sample of the union without replacement; as many
        # parts are filled as a union of about this size (a tenth more, for safety) fills
        union = -1.1 * BINS * np.log1p(-np.minimum(told, BINS - 1) / BINS)
        left = np.clip((union - told) / np.maximum(union - 1, 1), 0, 1)
        at = at[agree >= told * share - 1 - 5 * np.sqrt(told * share * (1 - share) * left)]
    return at


def _profiles(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, width, known) for t in texts_of(batch.column("text"))]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sketches = [sketch_of(s).astype("<u4").tobytes() if len(s) else None for s in sets]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.names.index(n)) for n in names]
                + [
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
                    pa.array([bytes_of(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                [*names, "n_shingles", "key", "sketch", "brief"],
            )

    return run


def _token(sketch: Column, at: Column) -> Column:
    """The sketch's token number ``at`` (four bytes each), as a binary."""
    return F.substring(sketch, at * 4 + 1, F.lit(4))


def _agreeing(share: float):
    """Pairs of a node's classes whose bytes agree. Rows come sorted by node; a node has at
    most ``SMALL`` rows."""

    def pairs(rows: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[bytes, bytes]]:
        if len(rows) > 1:
            briefs = _matrix([r[2] for r in rows])
            for i in range(len(rows) - 1):
                for j in alike(briefs[i], briefs[i + 1 :], share).tolist():
                    yield min(rows[i][1], rows[i + 1 + j][1]), max(rows[i][1], rows[i + 1 + j][1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        for batch in batches:
            out: set[tuple[bytes, bytes]] = set()
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    out.update(pairs(held))
                    held = []
                held.append(row)
            yield _pair_batch(out)
        yield _pair_batch(set(pairs(held)))

    return run


def _matrix(briefs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(briefs), np.uint8).reshape(len(briefs), BINS)


def _pair_batch(pairs: Iterable[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _usual(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent byte of every part over a node's few references."""
    for batch in batches:
        modes = []
        for briefs in batch.column("briefs").to_pylist():
            values = _matrix(briefs)
            modes.append(bytes(int(np.bincount(part).argmax()) for part in values.T))
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(modes, pa.binary())], ["node", "usual"])


def _central(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many parts a class agrees with its node's usual bytes."""
    for batch in batches:
        agree = [0] * len(batch)
        if len(batch):
            own, usual = (_matrix(batch.column(c).to_pylist()) for c in ("brief", "usual"))
            agree = (own == usual).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(agree, pa.int32()), batch.column("key")], ["node", "agree", "key"]
        )


def _near_centre(share: float):
    """Pairs of a class and its node's centre whose bytes agree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "brief", "centre", "centre_brief")))
            yield _pair_batch(
                [(a, b) for a, own, b, other in rows if len(alike(_matrix([own])[0], _matrix([other]), share))]
            )

    return run


# A row of a tile; ``nodes`` are all dense nodes of the class, the text comes with the second pass only.
_Row = namedtuple("_Row", "node slice block asks odd key root nodes brief text", defaults=(None,))
_TILE_ROW = "node long, slice long, block long, asks boolean, odd boolean, key binary, root binary, nodes array<long>, brief binary"


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[tuple, list[_Row], list[_Row]]]]:
    """(tile, its strangers, some of its members) of each batch. Rows come sorted by (node, slice, block),
    the strangers of a tile first and by key, at most about ``TILE`` of them."""
    tile: tuple | None = None
    asking: list[_Row] = []
    for batch in batches:
        names = [n for n in batch.schema.names if n != "text"]
        columns = [batch.column(n).to_pylist() for n in names]
        if "text" in batch.schema.names:
            columns.append(texts_of(batch.column("text")))
        rows = [_Row(*r) for r in zip(*columns)]
        found, start = [], 0
        while start < len(rows):
            here = rows[start][:3]
            if here != tile:
                tile, asking = here, []
            end = start
            while end < len(rows) and rows[end][:3] == here:
                if rows[end].asks:
                    if not asking or asking[-1].key != rows[end].key:
                        asking.append(rows[end])
                    start = end + 1
                end += 1
            if start < end:
                found.append((here, asking, rows[start:end]))
            start = end
        yield found


def _open_pairs(asking: list[_Row], members: list[_Row], share: float) -> Iterator[tuple[_Row, _Row]]:
    """Strangers and members in other components whose bytes agree. Of two strangers the one with the
    lesser key asks, and of all dense nodes that two classes share the least one has their pair."""
    briefs = _matrix([m.brief for m in members])
    for one in asking:
        own = set(one.nodes)
        for at in alike(np.frombuffer(one.brief, np.uint8), briefs, share).tolist():
            other = members[at]
            if other.root != one.root and not (other.odd and other.key < one.key) and min(own.intersection(other.nodes)) == one.node:
                yield one, other


def _needed(share: float):
    """Rows of a tile that are in any of its open pairs: as many at most as the tile has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _stretches(batches):
            out: list[_Row] = []
            for _, asking, members in found:
                chosen: dict[tuple[bool, bytes], _Row] = {}
                for pair in _open_pairs(asking, members, share):
                    chosen.update({(row.asks, row.key): row for row in pair})
                out += chosen.values()
            kinds = [pa.int64()] * 3 + [pa.bool_()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.int64()), pa.binary()]
            columns = list(zip(*out)) or [()] * len(_Row._fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(_Row._fields[:-1]))

    return run


def _linked(width: int, numerator: int, denominator: int):
    """Links among the open pairs of a tile, by full sets. Once two components are linked, no other
    pair of theirs is tried, so a tile gives fewer links than it has rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        tile, joined, own_sets = None, {}, {}

        def top(root: bytes) -> bytes:
            while root in joined:
                root = joined[root]
            return root

        for found in _stretches(batches):
            out = []
            for here, asking, members in found:
                if here != tile:
                    tile, joined, own_sets = here, {}, {}
                sets: dict[bytes, np.ndarray] = {}
                for one, other in _open_pairs(asking, members, numerator / denominator):
                    least, most = sorted((top(one.root), top(other.root)))
                    if least == most:
                        continue
                    for row, made in ((one, own_sets), (other, sets)):
                        if row.key not in made:
                            made[row.key] = shingle_set(row.text, width, known)
                    if _similar(own_sets[one.key], sets[other.key], numerator, denominator):
                        joined[most] = least
                        out.append((min(one.key, other.key), max(one.key, other.key)))
            yield _pair_batch(out)

    return run


def _similar(one: np.ndarray, other: np.ndarray, numerator: int, denominator: int) -> bool:
    common = len(np.intersect1d(one, other, assume_unique=True))
    return denominator * common >= numerator * (len(one) + len(other) - common)


def _confirm(width: int, numerator: int, denominator: int):
    """Pairs linked by their full sets. Rows: key, its own text (partner NULL) first, then partners' texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        own: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
        for batch in batches:
            out = []
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))]
            for a, b, text in zip(*columns):
                values = shingle_set(text, width, known)
                if b is None:
                    own = (a, values)
                elif own[0] == a and _similar(own[1], values, numerator, denominator):
                    out.append((a, b))
            yield _pair_batch(out)

    return run


class _Join:
    """One run of the join over classes (key, sketch) and a way to their shingle sets."""

    def __init__(self, classes: DataFrame, texts: DataFrame, width: int, share: tuple[int, int], trees: int):
        self.classes, self.texts, self.width, self.share, self.trees = classes, texts, width, share, trees
        self.similarity = share[0] / share[1]
        self.spark = classes.sparkSession

    def paths(self) -> tuple[DataFrame, DataFrame]:
        """(candidate pairs of small nodes, a row (key, places, brief, n_shingles) of each class in dense
        ones; ``places`` are those nodes and their sizes)."""
        roots = [F.xxhash64(F.lit(t), _token(F.col("sketch"), F.lit(t * 6 % SKETCH))) for t in range(self.trees)]
        rows = self.classes.select("key", F.lit(self.classes.count()).alias("parent"), F.explode(F.array(*roots)).alias("node"))
        few, dense = [], []
        while True:
            rows = materialize(rows, "paths")
            shared = rows.groupBy("node").agg(F.count("*").alias("size"), F.max("parent").alias("parent"))
            shared = materialize(shared.where("size > 1"), "nodes")
            # stored, so that a level's rows move once; most are alone in their node and do not move
            held = materialize(may_be_among(rows.drop("parent"), shared, "node").join(shared, "node"), "shared")
            few.append(held.where(f"size <= {SMALL}").select("node", "key"))
            large = held.where(f"size > {SMALL}")
            stuck = F.col("size") > F.col("parent") * DENSE
            dense.append(large.where(stuck).select("node", "key", "size"))
            if shared.where((F.col("size") > SMALL) & ~stuck).isEmpty():
                break
            chosen = [F.pmod(F.xxhash64("node", F.lit(i)), F.lit(SKETCH)).cast("int") for i in range(2)]
            # stored, so that few rows left are sent to the sketches and not all sketches to them
            going = materialize(large.where(~stuck), "large")
            rows = going.join(self.of(going, "key", "sketch"), "key").select(
                "key", F.col("size").alias("parent"),
                F.explode(
                    F.array(*[F.xxhash64("node", F.lit(i), _token(F.col("sketch"), c)) for i, c in enumerate(chosen)])
                ).alias("node"),
            )
        # small nodes of all levels meet in one pass, so a deep tree costs no pass a level; of nodes with
        # the same classes, as copies make in every tree, one is enough
        nodes = reduce(DataFrame.unionByName, few).groupBy("node").agg(F.array_sort(F.collect_set("key")).alias("keys"))
        once = nodes.groupBy("keys").agg(F.min("node").alias("node"))
        small = materialize(once.select("node", F.explode("keys").alias("key")), "small")
        pairs = (
            small.join(self.of(small, "key", "brief"), "key")
            .select("node", "key", "brief").repartition("node").sortWithinPartitions("node")
            .mapInArrow(_agreeing(self.similarity), "a binary, b binary")
        )
        places = reduce(DataFrame.unionByName, dense).groupBy("key").agg(F.collect_set(F.struct("node", "size")).alias("places"))
        places = materialize(places, "places")
        held = places.join(self.of(places, "key", "brief", "n_shingles"), "key")
        return materialize(pairs.distinct(), "candidates"), materialize(held, "dense")

    def of(self, keys: DataFrame, *columns: str) -> DataFrame:
        """``columns`` of the classes in ``keys`` and few others, for a join with them."""
        return may_be_among(self.classes.select(*columns), keys, "key")

    def fetch(self, keys: DataFrame) -> DataFrame:
        """(key, text) of one document of each class in ``keys``."""
        wanted = materialize(self.classes.join(keys, "key").select("key", "row_id", "at"), "wanted")
        held = may_be_among(self.texts, wanted, "at")
        return materialize(
            held.join(wanted, ["row_id", "at"]).dropDuplicates(["row_id", "at"]).select("key", "text"), "texts"
        )

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) whose full sets are similar. The set of ``a`` is held
        while the texts of its partners ``b`` pass, so a pair moves one text."""
        own = pairs.select("a", F.lit(None).cast("binary").alias("b"), F.col("a").alias("key")).distinct()
        asked = own.unionByName(pairs.select("a", "b", F.col("b").alias("key")))
        held = may_be_among(texts, pairs.select(F.explode(F.array("a", "b")).alias("key")), "key")
        return materialize(
            asked.join(held, "key").select("a", "b", "text").repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
            .mapInArrow(_confirm(self.width, *self.share), "a binary, b binary"),
            "links",
        )

    @staticmethod
    def rooted(roots: DataFrame, keys: DataFrame) -> DataFrame:
        """``keys`` with the component each is in so far, by ``roots`` (node, root)."""
        roots = roots.withColumnRenamed("node", "key")
        return keys.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))

    def stars(self, dense: DataFrame) -> DataFrame:
        """Candidates (a, b) of the classes of dense nodes with the most central class of their node."""
        rows = dense.select("key", "brief", F.inline("places"))
        every = F.ceil(F.col("size") / REFERENCES)
        few = rows.where(F.pmod(F.xxhash64("key", "node"), every) == 0)
        usual = few.groupBy("node").agg(F.collect_list("brief").alias("briefs")).mapInArrow(_usual, "node long, usual binary")
        scored = rows.join(usual, "node").select("node", "key", "brief", "usual")
        centre = (
            scored.mapInArrow(_central, "node long, agree int, key binary")
            .groupBy("node").agg(F.max(F.struct("agree", "key"))["key"].alias("centre"))
        )
        centre = materialize(
            centre.join(dense.select(F.col("key").alias("centre"), F.col("brief").alias("centre_brief")), "centre"), "centres"
        )
        near = rows.join(centre, "node").where("key <> centre")
        return near.mapInArrow(_near_centre(self.similarity), "a binary, b binary")

    def tiles(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Links of the classes (key, root, places, brief, n_shingles) that are in another component than
        the largest of their node. A class is copied once per tile it takes part in; texts come only
        to the tiles where bytes agree, and are compared there."""
        nodes = F.transform("places", lambda place: place["node"])
        spread = members.select("key", "root", "brief", "n_shingles", nodes.alias("nodes"), F.explode(nodes).alias("node"))
        sizes = spread.groupBy("node", "root").agg(F.count("*").alias("count"), F.sum("n_shingles").alias("weight"))
        most = F.max(F.struct("count", "root", "weight"))
        # strangers are held, so long texts make smaller tiles
        counts = sizes.groupBy("node").agg(
            most["root"].alias("most"),
            F.ceil(F.sum("count") / TILE).alias("slices"),
            F.greatest(
                F.ceil((F.sum("count") - most["count"]) / TILE), F.ceil((F.sum("weight") - most["weight"]) / (TILE << 10))
            ).alias("blocks"),
        )
        counts = materialize(counts.where("blocks > 0"), "most")
        rows = spread.join(counts, "node").withColumn("odd", F.col("root") != F.col("most"))
        own = F.xxhash64("key")
        upto = lambda count: F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
        both = [
            rows.select("*", F.pmod(own, "slices").alias("slice"), F.explode(upto("blocks")).alias("block"), F.lit(False).alias("asks")),
            rows.where("odd").select("*", F.explode(upto("slices")).alias("slice"), F.pmod(own, "blocks").alias("block"), F.lit(True).alias("asks")),
        ]
        columns = list(_Row._fields[:-1])
        dealt = materialize(both[0].unionByName(both[1]).select(*columns), "tiles")
        tasks = task_count(self.spark, dealt.count(), TILE)
        needed = materialize(self._by_tile(dealt, tasks).mapInArrow(_needed(self.similarity), _TILE_ROW), "needed")
        held = may_be_among(texts, needed, "key")
        return self._by_tile(needed.join(held, "key").select(*columns, "text"), tasks).mapInArrow(
            _linked(self.width, *self.share), "a binary, b binary"
        )

    @staticmethod
    def _by_tile(rows: DataFrame, tasks: int) -> DataFrame:
        by = ["node", "slice", "block"]
        return rows.repartition(tasks, *by).sortWithinPartitions(*by, F.desc("asks"), "key")

    def links(self) -> DataFrame:
        """Links (a, b) that join every class to its component."""
        pairs, dense = self.paths()
        texts = self.fetch(pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(dense.select("key")).distinct())
        ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min("b").alias("b")).unionByName(self.stars(dense))
        # of two classes that chose each other one row is enough
        first = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        tried = materialize(first, "first")
        links = self.confirmed(tried, texts)
        roots = components(links, "copies")
        members = materialize(self.rooted(roots, dense), "members")
        found = materialize(self.tiles(members, texts), "tile-links")
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        apart = pairs.join(known, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            apart = apart.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
        apart = apart.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
        rest = self.confirmed(materialize(apart, "apart"), texts)
        return materialize(links.unionByName(found).unionByName(rest), "all-links")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", width: int = 5, share: tuple[int, int] = (80, 100), trees: int = TREES
) -> DataFrame:
    """Every row of ``docs`` as (id, n_shingles, component_id, kept).

    Documents are linked when the intersection of their shingle sets is at least
    ``share`` of the union. ``component_id`` is the least id reachable. A document whose id is its component's
    is kept; of repeated rows all are. A row with NULL id
    joins the component of its text and goes; without a row with id that has its shingles
    it has no component (NULL) and stays.
    """
    texts = docs.select(
        F.col(f"`{id_column}`").alias("row_id"), F.col("text").cast("string").alias("text")
    ).withColumn("at", F.xxhash64("text"))
    profiles = materialize(
        texts.select("row_id", "at", "text").mapInArrow(
            _profiles(width), f"row_id {texts.schema['row_id'].dataType.simpleString()}, at long, n_shingles long, key binary, sketch binary, brief binary"
        ),
        "profiles",
    )
    filled = profiles.where("key IS NOT NULL")
    named = filled.where("row_id IS NOT NULL")
    # one row stands for a class: the least id, and of it the least text hash
    first = named.groupBy("key").agg(F.min(F.struct("row_id", "at")).alias("first"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief"), F.first("n_shingles").alias("n_shingles"))
    classes = materialize(first.select("key", "first.row_id", "first.at", "sketch", "brief", "n_shingles"), "classes")
    links = _Join(classes, texts, width, share, trees).links()
    roots = components(links, "duplicates")
    least = (
        classes.select("key", "row_id").join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "row_id", F.coalesce("root", "key").alias("root"))
    )
    of_root = materialize(least, "roots")
    names = of_root.groupBy("root").agg(F.min("row_id").alias("component_id"))
    of_class = materialize(of_root.join(names, "root").select("key", "component_id"), "named")
    return (
        profiles.select("row_id", "n_shingles", "key").join(of_class, "key", "left")
        .select(
            F.col("row_id").alias(id_column), "n_shingles", F.coalesce("component_id", "row_id").alias("component_id"),
        )
        .withColumn("kept", F.col("component_id").isNull() | F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))
    )

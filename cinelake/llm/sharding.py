"""Balanced sharding by label propagation under capacity quotas.

Documents with the same link (here: equal texts) are neighbours. They start spread
evenly, and in each round every one that is not where it should be asks for the shard
where most of its neighbours are; a group too large for one shard is dealt over its most
popular ones, by a hash of the document and in the measure of a shard's capacity.
Between two shards as many move one way as the other, and beyond that as many as the
target has room for. Documents without neighbours fill what is left, so the numbers of
rows differ by one at most (law ``rows``) and never by more during the rounds.

Neighbours are counted per (link, shard) before any shuffle by link. A rank is a count
of smaller buckets plus a place within a bucket, so no shard is sorted as a whole.

A NULL link has no neighbours. Repeated rows are rows of their own. Fewer rows than
shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.session import materialize

SHARDS, ROUNDS, BUCKETS = 24, 4, 1024


def _ranked(df: DataFrame, within: list[str], order: list[str], name: str, spread: Column | None = None) -> DataFrame:
    """Gapless rank from 0 within groups, in the order of ``order`` after a hash bucket.

    The number of groups must be bounded: the table of bucket counts is broadcast, and has
    at most groups x ``BUCKETS`` rows.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)) if spread is None else spread
    dealt = df.withColumn("bucket", bucket)
    counts = materialize(dealt.groupBy(*within, "bucket").count(), "bucket-counts")
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    place = F.row_number().over(Window.partitionBy(*within, "bucket").orderBy(*order)) - 1
    joined = dealt.withColumn("place", place).join(F.broadcast(starts), [*within, "bucket"])
    return joined.withColumn(name, F.col("start") + F.col("place")).drop("bucket", "start", "place")


def _round(linked: DataFrame, capacity: Column, free: dict[int, int], shards: int) -> DataFrame:
    """(row, link, size, shard) after one round of moves; ``free`` is the room of each shard."""
    here = linked.groupBy("link", "shard").agg(F.count("*").alias("n"))
    # a tie goes to a shard of the link's own choice
    ranked = here.groupBy("link").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")), asc=False),
            lambda x: x["shard"],
        ).alias("choices")
    )  # at most ``shards`` entries per link
    choices = materialize(ranked, "choices")
    part = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    step = F.floor(part * F.col("size") / capacity).cast("int")
    asked = linked.join(choices, "link").withColumn(
        "want", F.coalesce(F.get("choices", step), F.pmod(F.col("shard") + 1 + step, F.lit(shards)).cast("int"))
    )
    asked = materialize(asked.select("row", "link", "size", "shard", "want"), "asked")
    movers = asked.where("want <> shard")
    flows = {(r.shard, r.want): r.n for r in movers.groupBy("shard", "want").agg(F.count("*").alias("n")).collect()}
    room, quota = dict(free), {}
    for (a, b), n in sorted(flows.items(), key=lambda x: (-x[1], x[0])):
        even = min(n, flows.get((b, a), 0))
        more = min(n - even, room.get(b, 0))
        room[b] = room.get(b, 0) - more
        quota[a, b] = even + more
    spark = linked.sparkSession
    rows = [(a, b, n) for (a, b), n in quota.items()] or [(-1, -1, 0)]
    quotas = spark.createDataFrame(rows, "shard int, want int, quota long")  # at most shards x shards rows
    ranked = _ranked(movers, ["shard", "want"], ["link", "row"], "rank", F.pmod(F.xxhash64("link"), F.lit(BUCKETS)))
    moved = ranked.join(F.broadcast(quotas), ["shard", "want"]).select(
        "row", "link", "size", F.when(F.col("rank") < F.col("quota"), F.col("want")).otherwise(F.col("shard")).alias("shard")
    )
    return asked.where("want = shard").select("row", "link", "size", "shard").unionByName(moved)


def shard_rows(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (row: a value of its own for every row, link) with ``shard`` and ``slot``."""
    sizes = materialize(
        rows.where("link IS NOT NULL").groupBy("link").agg(F.count("*").alias("size")).where("size > 1"), "link-sizes"
    )
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    linked = rows.join(sizes, "link").select("row", "link", "size")
    start = _ranked(linked.withColumn("all", F.lit(0)), ["all"], ["row"], "rank").select(
        "row", "link", "size", F.pmod("rank", F.lit(shards)).cast("int").alias("shard")
    )
    state = materialize(start, "linked")
    for turn in range(rounds + 1):
        held = {r.shard: r.n for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        free = {s: capacity[s] - held.get(s, 0) for s in range(shards)}
        if turn == rounds or not held:
            break
        state = materialize(_round(state, F.lit(max(1.0, float(total // shards))), free, shards), "linked")
    single = rows.join(state.select(F.col("row").alias("placed")), F.col("row") == F.col("placed"), "left_anti")
    ranked = _ranked(single.select("row", F.lit(0).alias("all")), ["all"], ["row"], "rank")
    ends, end = [], 0
    for s in range(shards):
        end += free[s]
        ends.append(end)
    ends_array = F.array(*[F.lit(e).cast("long") for e in ends])
    filled = ranked.select("row", F.size(F.filter(ends_array, lambda e: e <= F.col("rank"))).cast("int").alias("shard"))
    placed = state.select("row", "shard").unionByName(filled)
    return _ranked(materialize(placed, "placed"), ["shard"], ["row"], "slot")


def shard_documents(docs: DataFrame, id_column: str = "doc_id", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row as (id, size, text_crc32, shard, slot); documents of equal text are linked."""
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(f"`{id_column}`").alias(id_column),
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("link"),
        F.monotonically_increasing_id().alias("row"),
    )
    narrow = materialize(narrow, "sized")  # from here on, a row keeps its number
    placed = shard_rows(narrow.select("row", "link"), shards, rounds)
    return narrow.join(placed, "row").select(
        id_column, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "link"
    )


def cut_links(placed: DataFrame) -> int:
    """Pairs of neighbours in different shards."""
    inside = placed.where("link IS NOT NULL").groupBy("link", "shard").count()
    sums = inside.groupBy("link").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("same"))
    return sums.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2)).first()[0] or 0

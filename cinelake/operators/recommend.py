"""Scores and top lists of the recommenders.

Everything is long: (user, content, score). A user's list is assembled from
arrays of at most 30 entries, so no step holds more than that per user.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinelake.functions.scalars import default_title, novelty_factor
from cinelake.operators.matrix import DIGITS, Matrix, popularity
from cinelake.operators.pairwise import top_positive
from cinelake.operators.similarity import both_ways, centred_user_units
from cinelake.session import cores, materialize, task_count

# Sizes and thresholds of the recommenders.
SIMILAR_USERS = 20
LIST_SIZE = 10
SIMILAR_ITEMS = 15
MIN_USER_MINUTES = 50
MIN_VIEWERS = 3
POOL_SIZE = LIST_SIZE * 3

# Cells a task takes on before they are multiplied by their neighbours.
CELLS_PER_TASK = 250_000

# Similarities of a tile, some 64 MB, and cells of a block of users that meet it in a task.
NEAR_PER_TILE = 4_000_000
CELLS_PER_BLOCK = 1_000_000
OFFERS_PER_STEP = 500_000
SENT_PER_BLOCK = 2_000_000

# Rows of three numbers up to which a counted table is broadcast, some 50 MB as a hash table.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a table whose counted rows allow it. Beyond that the join
    is a sort-merge join, whose skewed partitions are split at run time."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def user_totals(matrix: Matrix) -> DataFrame:
    return matrix.cells.groupBy("Customer_Key").agg(F.sum("Minutes").alias("Total_Minutes"))


def _lowest_users(matrix: Matrix, k: int) -> DataFrame:
    """The ``k`` + 1 lowest user keys."""
    return matrix.cells.select("Customer_Key").distinct().orderBy("Customer_Key").limit(k + 1)


def _fillers(lowest: Column, near: Column, row: Column, k: int) -> Column:
    """The lowest keys that fill up a list of ``near`` users to ``k``.

    At most k of the lowest keys can be taken already (by the user or a positive
    neighbour), so the k + 1 lowest keys hold every filler.
    """
    free = F.filter(lowest, lambda key: (key != row) & ~F.array_contains(near, key))
    return F.slice(free, F.lit(1), F.greatest(F.lit(k) - F.size(near), F.lit(0)))


def similar_users(matrix: Matrix, k: int = SIMILAR_USERS) -> DataFrame:
    """The k most similar users of each user, as (row, other, similarity).

    Negative similarity counts as 0. A user with fewer than k positive ones is
    filled up with the lowest keys at similarity 0; those weigh nothing in a score
    but count as viewers.
    """
    k = min(k, matrix.users - 1)
    if k < 1:
        return matrix.cells.sparkSession.createDataFrame([], "row BIGINT, other BIGINT, similarity DOUBLE")
    positive = positive_users(matrix, k)
    users = matrix.cells.select("Customer_Key").distinct()
    lowest = _lowest_users(matrix, k).agg(F.array_sort(F.collect_list("Customer_Key")))
    per_user = positive.groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("other", "similarity")).alias("_near")
    )
    near = F.coalesce(
        F.col("_near"), F.array().cast("array<struct<other:bigint,similarity:double>>")
    )
    listed = users.join(per_user, users["Customer_Key"] == per_user["_row"], "left").select(
        F.col("Customer_Key").alias("row"), near.alias("_near"), lowest.scalar().alias("_lowest")
    )
    others = F.transform("_near", lambda n: n["other"])
    fill = F.transform(
        _fillers(F.col("_lowest"), others, F.col("row"), k),
        lambda key: F.struct(key.alias("other"), F.lit(0.0).alias("similarity")),
    )
    return listed.select("row", F.explode(F.concat("_near", fill)).alias("n")).select(
        "row", F.col("n.other").alias("other"), F.col("n.similarity").alias("similarity")
    )


def positive_users(matrix: Matrix, k: int = SIMILAR_USERS) -> DataFrame:
    """The users among the k most similar ones whose similarity is positive."""
    return top_positive(centred_user_units(matrix), matrix.users, matrix.cell_count, k)


def _scored(base: DataFrame) -> DataFrame:
    """Apply the novelty factor for the minutes the user already spent on the content."""
    own = F.coalesce("_own", F.lit(0.0))
    return base.select(
        "Customer_Key",
        "Content_Key",
        F.round(F.col("_weighted") / F.col("_weight") * novelty_factor(own), DIGITS).alias("Score"),
        own.alias("Own_Minutes"),
    )


_NOTHING = "CAST(NULL AS DOUBLE) AS similarity"


def _own_minutes() -> Column:
    return F.max(F.when(F.col("similarity").isNull(), F.col("Minutes"))).alias("_own")


def _viewed_by(asked: DataFrame, viewed: DataFrame, cell_count: int, tasks: int) -> DataFrame:
    """What the ``other`` of each asked row viewed, in partitions by ``row``. Where the cells are too many
    to broadcast, a user's cells travel as one array and are dealt out after the rows have come together."""
    if cell_count <= BROADCAST_ROWS:
        return asked.repartition(tasks, "row").join(F.broadcast(viewed), "other")
    cells = viewed.groupBy("other").agg(F.collect_list(F.struct("Content_Key", "Minutes")).alias("_cells"))
    return (
        asked.join(cells, "other")
        .repartition(tasks, "row")
        .select("row", "similarity", F.explode("_cells").alias("c"))
        .select("row", "similarity", "c.Content_Key", "c.Minutes")
    )


def score_by_users(matrix: Matrix, neighbours: DataFrame, k: int = SIMILAR_USERS) -> DataFrame:
    """Similarity-weighted mean minutes of the similar users who saw a content.

    Only users with 50 minutes or more get scores, and only contents that three
    or more of their k similar users saw. Each user also stands among the similar
    ones, without a similarity: that row brings along the own minutes, which
    would otherwise take a second join of all scores with the matrix.

    Users of similarity 0, who fill up short lists, weigh nothing and are the same
    few for all. They take no part in the join (rows of ``neighbours`` with
    similarity 0 are not needed): a content lists which of the lowest keys saw it, and
    a vote that lacks viewers counts those that fill up its user's list.
    """
    k = min(k, matrix.users - 1)
    active = user_totals(matrix).filter(F.col("Total_Minutes") >= MIN_USER_MINUTES)
    selves = active.selectExpr("Customer_Key AS row", "Customer_Key AS other", _NOTHING)
    positive = neighbours.filter(F.col("similarity") > 0).select("row", "other", "similarity")
    asked = positive.join(active, positive["row"] == active["Customer_Key"], "left_semi").unionByName(selves)
    viewed = matrix.seen.withColumnRenamed("Customer_Key", "other")
    tasks = task_count(matrix.cells.sparkSession, matrix.users * SIMILAR_USERS, CELLS_PER_TASK)
    asked = materialize(asked.repartition(tasks, "row"), "asked")
    votes = (
        _viewed_by(asked, viewed, matrix.cell_count, tasks)
        .groupBy(F.col("row").alias("Customer_Key"), "Content_Key")
        .agg(
            F.count("similarity").alias("_viewers"),
            F.sum("similarity").alias("_weight"),
            F.sum(F.col("similarity") * F.col("Minutes")).alias("_weighted"),
            _own_minutes(),
        )
        .filter(F.col("_weight") > 0)
    )
    lowest = _lowest_users(matrix, k)
    seen_by = (
        matrix.seen.join(F.broadcast(lowest), "Customer_Key", "left_semi")
        .groupBy(F.col("Content_Key").alias("_content"))
        .agg(F.collect_list("Customer_Key").alias("_low_viewers"))
    )
    near = F.array_compact(F.collect_list(F.when(F.col("similarity").isNotNull(), F.col("other"))))
    keys = lowest.agg(F.array_sort(F.collect_list("Customer_Key"))).scalar()
    short = (
        asked.groupBy(F.col("row").alias("_user"))
        .agg(near.alias("_near"))
        .filter(F.size("_near") < k)
        .withColumn("_lowest", keys)
        .select("_user", _fillers(F.col("_lowest"), F.col("_near"), F.col("_user"), k).alias("_fill"))
    )
    lacking = F.col("_viewers") < MIN_VIEWERS
    counted = votes.join(short, (F.col("Customer_Key") == F.col("_user")) & lacking, "left").join(
        broadcast_if_small(seen_by, matrix.items * (k + 1)), (F.col("Content_Key") == F.col("_content")) & lacking, "left"
    )
    filled = F.coalesce(F.size(F.array_intersect("_fill", "_low_viewers")), F.lit(0))
    return _scored(counted.filter(F.col("_viewers") + F.greatest(filled, F.lit(0)) >= MIN_VIEWERS))


_BEST = "array<struct<down:double,item:bigint,minutes:double>>"


def _best_offers(k: int, whole: bool):
    """For a block of users and a tile of similarities: of each (user, candidate) the best k of
    the user's contents in the tile, and the minutes of each cell itself. A tile that holds the
    ``whole`` of the similarities gives, in place of the lists, their sums."""

    def lists(starts: np.ndarray, total: int, down, item, minutes) -> pa.Array:
        entry = pa.StructArray.from_arrays(
            [pa.array(down), pa.array(item), pa.array(minutes)], ["down", "item", "minutes"]
        )
        return pa.ListArray.from_arrays(pa.array(np.r_[starts, total].astype(np.int32)), entry)

    def sums(starts: np.ndarray, down, minutes) -> dict[str, pa.Array]:
        # one entry of every list after the other, as a fold over the list adds them
        size = np.diff(np.r_[starts, len(down)])
        weight, weighted = np.zeros((2, len(starts)))
        for n in range(size.max(initial=0)):
            at = np.flatnonzero(size > n)
            weight[at] -= down[starts[at] + n]
            weighted[at] -= down[starts[at] + n] * minutes[starts[at] + n]
        return {"weight": pa.array(weight), "weighted": pa.array(weighted)}

    def task(cells: pa.Table, near: pa.Table) -> pa.Table:
        user, item = cells["Customer_Key"].to_numpy(), cells["Content_Key"].to_numpy()
        minutes = cells["Minutes"].to_numpy()
        by = np.lexsort((item, user))
        user, item, minutes = user[by], item[by], minutes[by]
        order = np.argsort(near["item"].to_numpy(), kind="stable")
        offered_by = near["item"].to_numpy()[order]
        candidate, similarity = near["other"].to_numpy()[order], near["similarity"].to_numpy()[order]
        first = np.searchsorted(offered_by, item, "left")
        count = np.searchsorted(offered_by, item, "right") - first
        done = np.r_[0, np.cumsum(count)]
        none, out = np.empty(0), []

        def give(users: np.ndarray, items: np.ndarray, own, starts, down, item, minutes) -> None:
            found = {
                "Customer_Key": pa.array(users, pa.int64()),
                "Content_Key": pa.array(items, pa.int64()),
                "own": pa.nulls(len(users), pa.float64()) if own is None else pa.array(own),
            }
            if whole:
                found |= sums(starts, down, minutes)
            else:
                found["best"] = lists(starts, len(down), down, item, minutes)
            out.append(pa.table(found))

        if not whole:
            give(user, item, minutes, np.zeros(len(user), int), none, none.astype(int), none)
        users = np.flatnonzero(np.r_[True, user[1:] != user[:-1], True][: len(user) + 1]) if len(user) else np.zeros(1, int)
        at = 0  # a step takes whole users, so that no (user, candidate) is split
        while at < len(users) - 1:
            upto = int(np.searchsorted(done[users], done[users[at]] + OFFERS_PER_STEP, "right")) - 1
            upto = min(max(upto, at + 1), len(users) - 1)
            a, b = users[at], users[upto]
            at = upto
            own = np.repeat(np.arange(a, b), count[a:b])
            place = np.arange(done[b] - done[a]) + np.repeat(first[a:b] - (done[a:b] - done[a]), count[a:b])
            wanted, down = candidate[place], -similarity[place]
            by = np.lexsort((item[own], down, wanted, user[own]))
            own, wanted, down = own[by], wanted[by], down[by]
            fresh = np.r_[True, (wanted[1:] != wanted[:-1]) | (user[own[1:]] != user[own[:-1]])][: len(own)]
            starts = np.flatnonzero(fresh)
            rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
            kept = rank < k
            own, wanted, down = own[kept], wanted[kept], down[kept]
            starts = np.flatnonzero(fresh[kept])
            mine = None
            if whole:  # the user's own minutes on the candidate, where there is such a cell
                mine = _own_cells(user[a:b], item[a:b], minutes[a:b], user[own[starts]], wanted[starts])
            give(user[own[starts]], wanted[starts], mine, starts, down, item[own], minutes[own])
        if not out:
            give(user[:0], item[:0], none, none.astype(int), none, none.astype(int), none)
        return pa.concat_tables(out)

    return task


def _own_cells(user: np.ndarray, item: np.ndarray, minutes: np.ndarray, users: np.ndarray, items: np.ndarray) -> pa.Array:
    """Minutes of the wanted (user, item) among cells sorted by both, missing where there is no cell."""
    names, number = np.unique(item, return_inverse=True)
    people, person = np.unique(user, return_inverse=True)
    cell = person * len(names) + number
    place = np.minimum(np.searchsorted(names, items), len(names) - 1)
    wanted = np.searchsorted(people, users) * len(names) + place
    at = np.minimum(np.searchsorted(cell, wanted), len(cell) - 1)
    return pa.array(minutes[at], mask=(cell[at] != wanted) | (names[place] != items))


def score_by_items(matrix: Matrix, pairs: DataFrame, k: int = SIMILAR_ITEMS) -> DataFrame:
    """Similarity-weighted mean minutes a user spent on the k seen contents most
    similar to a candidate; only positive similarity counts.

    Similarities are stored as tiles by the offering content, and cells are blocked by
    user; a block meets a tile in one task, which sends on the best k per user and
    candidate only. Those partial lists are merged per user and candidate; where one tile
    holds all similarities, the task sends on their sums. A cell goes to one task, a tile to
    each block of users. What offers a task makes from its cells stays there, a bounded
    number at a time, and a block has so few cells that what is sent on is bounded as well.
    """
    near = materialize(both_ways(pairs.filter(F.col("similarity") > 0)), "near")
    spark = matrix.cells.sparkSession
    size = near.agg(F.count("*").alias("n"), F.count_distinct("other").alias("others")).first()
    tiles = max(1, -(-size["n"] // NEAR_PER_TILE))
    # of what a user is sent, there is an entry (of k, unless summed) per candidate
    per_user = min(size["others"], -(-size["n"] // tiles)) * (1 if tiles == 1 else k)
    blocks = max(
        -(-matrix.cell_count // CELLS_PER_BLOCK), -(-matrix.users * per_user // SENT_PER_BLOCK), -(-cores(spark) // tiles)
    )
    tile = lambda key: F.pmod(F.xxhash64(key), F.lit(tiles))
    cells = matrix.seen.select(
        F.pmod(F.xxhash64("Customer_Key"), F.lit(blocks)).alias("block"), tile("Content_Key").alias("tile"),
        "Customer_Key", "Content_Key", F.col("Minutes").cast("double").alias("Minutes"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    offers = near.select(every.alias("block"), tile("item").alias("tile"), "item", "other", "similarity")
    found = "weight DOUBLE, weighted DOUBLE" if tiles == 1 else f"best {_BEST}"
    partial = (
        cells.groupBy("block", "tile")
        .cogroup(offers.groupBy("block", "tile"))
        .applyInArrow(
            lambda left, right: _best_offers(k, tiles == 1)(left, right),
            f"Customer_Key BIGINT, Content_Key BIGINT, own DOUBLE, {found}",
        )
    )
    if tiles == 1:
        return _scored(partial.withColumnsRenamed({"own": "_own", "weight": "_weight", "weighted": "_weighted"}))
    merged = partial.groupBy("Customer_Key", "Content_Key").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("_best"), F.max("own").alias("_own")
    )
    zero = F.lit(0.0)
    return _scored(
        merged.filter(F.size("_best") > 0).select(
            "Customer_Key",
            "Content_Key",
            F.aggregate("_best", zero, lambda total, x: total - x["down"]).alias("_weight"),
            F.aggregate("_best", zero, lambda total, x: total - x["down"] * x["minutes"]).alias("_weighted"),
            "_own",
        )
    )


def popular_contents(matrix: Matrix, size: int = POOL_SIZE) -> DataFrame:
    return popularity(matrix).orderBy(F.desc("Popularity"), "Content_Key").limit(size)


def popular_pool(matrix: Matrix, size: int = POOL_SIZE) -> DataFrame:
    """The most popular contents in order, as one array of (down, Content_Key)."""
    top = popular_contents(matrix, size)
    entry = F.struct((-F.col("Popularity")).alias("down"), "Content_Key")
    return top.agg(F.array_sort(F.collect_list(entry)).alias("_pool"))


def _entry(down: Column, source: Column, order: Column, item: Column, own: Column) -> Column:
    return F.struct(
        down.alias("down"),
        source.cast("int").alias("source"),
        order.cast("bigint").alias("order"),
        item.cast("bigint").alias("item"),
        own.cast("double").alias("own"),
    )


_ENTRY_ARRAY = "array<struct<down:double,source:int,order:bigint,item:bigint,own:double>>"


def top_lists(scored: DataFrame, matrix: Matrix, size: int = LIST_SIZE, pool_size: int = POOL_SIZE) -> DataFrame:
    """Each user's best ``size`` contents, as (Customer_Key, Rank, Content_Key, Score, Own_Minutes).

    A user with fewer scored contents than ``size`` also gets popular ones, until
    ``pool_size`` candidates are there. Equal scores order scored contents by key
    before popular ones by popularity.
    """
    rank = F.row_number().over(W.partitionBy("Customer_Key").orderBy(F.desc("Score"), "Content_Key"))
    lists = (
        scored.withColumn("_rank", rank)
        .filter(F.col("_rank") <= size)
        .groupBy(F.col("Customer_Key").alias("_user"))
        .agg(
            F.collect_list(
                _entry(-F.col("Score"), F.lit(0), F.col("Content_Key"), F.col("Content_Key"), F.col("Own_Minutes"))
            ).alias("_scored")
        )
    )
    users = matrix.cells.select("Customer_Key").distinct()
    popular = F.broadcast(popular_contents(matrix, pool_size).select("Content_Key"))
    own_popular = (
        matrix.cells.join(popular, "Content_Key", "left_semi")
        .groupBy(F.col("Customer_Key").alias("_owner"))
        .agg(F.map_from_entries(F.collect_list(F.struct("Content_Key", "Minutes"))).alias("_own"))
    )
    joined = (
        users.join(lists, users["Customer_Key"] == lists["_user"], "left")
        .join(own_popular, users["Customer_Key"] == own_popular["_owner"], "left")
        .withColumns(
            {
                "_scored": F.coalesce("_scored", F.array().cast(_ENTRY_ARRAY)),
                "_pool": popular_pool(matrix, pool_size).scalar(),
            }
        )
    )
    fresh = F.filter(
        "_pool",
        lambda p: ~F.array_contains(F.transform("_scored", lambda s: s["item"]), p["Content_Key"]),
    )

    def popular_entry(p: Column, position: Column) -> Column:
        own = F.coalesce(F.try_element_at(F.col("_own"), p["Content_Key"]), F.lit(0.0))
        score = F.round(-p["down"] * novelty_factor(own), DIGITS)
        return _entry(-score, F.lit(1), position, p["Content_Key"], own)

    filled = F.concat(
        "_scored",
        F.transform(F.slice(fresh, F.lit(1), F.lit(pool_size) - F.size("_scored")), popular_entry),
    )
    chosen = F.when(F.size("_scored") < size, filled).otherwise(F.col("_scored"))
    ranked = F.slice(F.array_sort(chosen), 1, size)
    return joined.select("Customer_Key", F.posexplode(ranked).alias("_at", "r")).select(
        "Customer_Key",
        (F.col("_at") + 1).alias("Rank"),
        F.col("r.item").alias("Content_Key"),
        (-F.col("r.down")).alias("Score"),
        F.col("r.own").alias("Own_Minutes"),
    )


def wide_lists(lists: DataFrame, titles: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """One row per user with key, title and score of every position.

    ``titles`` is (Content_Key, Titulo); a content it lacks is called by its key.
    """
    named = lists.join(titles, "Content_Key", "left").withColumn(
        "Titulo", F.coalesce("Titulo", default_title(F.col("Content_Key")))
    )

    def at(position: int, column: str, name: str) -> Column:
        return F.max(F.when(F.col("Rank") == position, F.col(column))).alias(f"Recomendacion_{position}_{name}")

    named = named.withColumn("_score", F.bround("Score", 4))
    places = [
        at(p, column, name)
        for p in range(1, size + 1)
        for column, name in (("Content_Key", "ContentKey"), ("Titulo", "Titulo"), ("_score", "Score"))
    ]
    return (
        named.groupBy("Customer_Key")
        .agg(F.count("*").alias("Num_Recomendaciones"), *places)
        .orderBy("Customer_Key")
    )

"""Merkle manifest of a table by nested-struct rollup, with an inclusion proof per row.

Rows are ranked within their group; a rank's base-8 digits are its way up the tree. A
block (512 consecutive ranks) is shuffled together once, and its rows are grouped by all
digits but the last, then by one digit less, and so on: each grouping hashes the children
and nests them in the parent's struct. Block roots are the rows of the next tier, until
every group is one block; the groups' roots are ranked and rolled up the same way.

Proofs come back down by transform and explode: a node hands each child what stands left
and right of it, so within a block nothing is joined. Between tiers a block meets its own
way up, one narrow row for 512, by (group, rank); no key repeats there.

A rank is a place in a range-sorted partition plus what stands before it, so no task sees
a whole group. The number of tiers is the only value that reaches the driver.

NULL fields count as ``-``; a NULL group is a group of its own and stands first; a NULL id
stands before all ids of its group. Rows of equal id stand in the order of their digests,
and rows that repeat altogether are rows of their own. A text is hashed whole, however long. An
empty text is not NULL. An empty table gives no rows. Other columns of the input, whatever
their names, are not read; ``carry`` takes columns along under names of the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.session import materialize

FAN = 8
DIGITS = 3  # of a block: its 512 rows are nested in one struct
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_INDEX_BITS = 33  # of a row's place within its partition, by definition of the function


def field_text(value: Column) -> Column:
    """A field as it enters a digest: its UTF-8 length and itself, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields in a row."""
    return F.sha2(F.concat(*[field_text(f) for f in fields]).cast("binary"), 256)


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``rank`` (gapless from 0) within ``g``, and ``n``, the rows of ``g``."""
    by = ["g", *order]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = materialize(sorted_rows.withColumn("place", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("place", _INDEX_BITS))
    index = F.col("place") - F.shiftleft("part", _INDEX_BITS)
    runs = placed.groupBy("g", "part").agg(F.min(index).alias("first"), F.count("*").alias("held"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "g", "part", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(Window.partitionBy("g")).alias("n"),
    )
    joined = placed.join(materialize(runs, f"{label}-runs"), ["g", "part"])
    return joined.withColumn("rank", index + F.col("shift")).drop("part", "place", "shift")


def _rolled(nodes: DataFrame, base: int) -> DataFrame:
    """(g, n, rank, h, kids): blocks of ``nodes`` (g, n, rank, h, c), whose own level is ``base``.

    A level with a single node is the group's top: from there on a node is its only child.
    """
    block = F.floor(F.col("rank") / F.lit(FAN**DIGITS))
    rows = nodes.withColumn("block", block).repartition("g", "block")
    for level in range(base, base + DIGITS):
        child = F.struct(F.pmod("rank", F.lit(FAN)).cast("int").alias("digit"), "h", "c")
        rows = rows.groupBy("g", "n", "block", F.floor(F.col("rank") / F.lit(FAN)).alias("up")).agg(
            F.sort_array(F.collect_list(child)).alias("kids")
        )
        hashes = F.transform("kids", lambda kid: kid["h"])
        node = F.when(F.col("n") > FAN**level, F.sha2(F.array_join(hashes, ""), 256)).otherwise(F.get(hashes, F.lit(0)))
        rows = rows.select("g", "n", "block", F.col("up").alias("rank"), node.alias("h"), F.col("kids").alias("c"))
    return rows.select("g", "n", "rank", "h", F.col("c").alias("kids"))


def _tiers(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Stored blocks of each tier, the last of which has one block per group."""
    tiers, nodes = [], leaves
    while True:
        base = DIGITS * len(tiers)
        blocks = materialize(_rolled(nodes, base), f"{label}-tier")
        tiers.append(blocks)
        if blocks.where(F.col("n") > FAN ** (base + DIGITS)).isEmpty():
            return tiers
        nodes = blocks.select("g", "n", "rank", "h", F.lit(None).cast("boolean").alias("c"))


def _opened(rows: DataFrame, level: int, along: list[str]) -> DataFrame:
    """One row per child of ``kids``: its rank, digest, own children ``c`` and way up, nearest step first."""
    hashes = F.transform("kids", lambda kid: kid["h"])
    sides = F.transform(
        "kids",
        lambda kid, at: F.struct(
            kid["digit"].alias("digit"), kid["h"].alias("h"), kid["c"].alias("c"),
            F.struct(
                F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
                F.array_join(F.slice(hashes, at + 2, F.lit(FAN)), "").alias("right"),
            ).alias("step"),
        ),
    )
    each = rows.select("g", "n", "rank", "path", *along, F.explode(sides).alias("kid"))
    path = F.when(F.col("n") > FAN**level, F.concat(F.array("kid.step"), F.col("path"))).otherwise(F.col("path"))
    rank = F.col("rank") * FAN + F.col("kid.digit")
    return each.select("g", "n", rank.alias("rank"), path.alias("path"), *along, "kid.h", "kid.c")


def _descended(tiers: list[DataFrame], tops: DataFrame, along: list[str], label: str) -> DataFrame:
    """(g, rank, h, c, path) of every leaf, given (g, path, columns ``along``) of each group."""
    ways = tops.withColumn("rank", F.lit(0).cast("long"))
    for number in range(len(tiers) - 1, -1, -1):
        rows = tiers[number].select("g", "n", "rank", "kids").join(ways, ["g", "rank"])
        for level in range(DIGITS * (number + 1) - 1, DIGITS * number - 1, -1):
            rows = _opened(rows, level, along)
            if level > DIGITS * number:
                rows = rows.withColumnRenamed("c", "kids")
        if number:
            ways = materialize(rows.select("g", "rank", "path", *along), f"{label}-ways")
    return rows


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Every row of ``docs``: its id, ``carry``, ``rank`` in its group, ``leaf``, ``subroot`` of
    the group, ``root`` of the table, and ``path``: what stands left and right of it, level by
    level from the leaf to the root."""
    carry = carry or {}
    named = F.col(f"`{group}`").cast("string")
    own = F.struct(F.col(f"`{id_column}`").alias("id"), *[column.alias(f"x{n}") for n, column in enumerate(carry.values())])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("g"),
        F.col(f"`{id_column}`").alias("id"), digest(*[F.col(f"`{f}`") for f in fields]).alias("h"), own.alias("c"),
        F.monotonically_increasing_id().alias("at"),
    )
    leaves = materialize(leaves, "leaves")
    ranked = _ranked(leaves, ["id", "h", "at"], "ranked-leaves")
    tiers = _tiers(ranked.select("g", "n", "rank", "h", "c"), "leaf")

    subroots = tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("c"), "h")
    groups = _tiers(_ranked(subroots, ["c"], "ranked-groups").select("g", "n", "rank", "h", "c"), "group")
    start = groups[-1].select(
        "g", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("h").alias("root")
    )
    tops = _descended(groups, start, ["root"], "group")
    tops = materialize(tops.select(F.col("c").alias("g"), "path", "root", F.col("h").alias("subroot")), "subroots")

    found = _descended(tiers, tops, ["root", "subroot"], "leaf")
    return found.select(
        F.col("c.id").alias(id_column), *[F.col(f"c.x{n}").alias(name) for n, name in enumerate(carry)],
        "rank", F.col("h").alias("leaf"), "subroot", "root", "path",
    )


def proof(path: Column) -> Column:
    """SHA-256 of a path's siblings in a row."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with a path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))

"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.session import materialize


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Each round takes the least label among neighbours, then the label of that label, so
    a chain needs a number of rounds that grows with the logarithm of its length. A
    node with many edges is combined before the shuffle and split in the joins.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"),
        f"{label}-edges",
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), label)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("near")
        )
        lower = materialize(
            labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), label
        )
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        labels_next = materialize(
            lower.join(jump, "root", "left").select("node", "old", F.least("root", "far").alias("root")), label
        )
        moved = not labels_next.where("root <> old").isEmpty()
        labels = labels_next.select("node", "root")
        if not moved:
            return labels

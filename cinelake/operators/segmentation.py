"""User segments: features, scaling, K-Means, labels and quality."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.scalars import to_key, to_number
from cinelake.operators.pairwise import MAX_TASKS, blocks_for, busy_blocks, dealt, held_blocks, stretch_pairs
from cinelake.session import cores, materialize
from cinelake.sources.readers import require_rows, resolve_columns
from cinelake.sources.schemas import EVENT_ALIASES

ROWS_PER_BLOCK = 16_384
BLOCKS_PER_STRETCH = 64  # a task holds the summed distances of two stretches of blocks

# Points whose distances are written out at a time, 1 MB.
ROWS_PER_STEP, COLUMNS_PER_STEP = 128, 1024

FEATURES = ["total_eventos", "total_minutos", "promedio_minutos"]

# Settings and names of the segments.
CLUSTERS = 3
SEED = 42
STARTS = 10
MAX_ITERATIONS = 300
POWER = "Power Users"
REGULAR = "Regular Users"
DORMANT = "Dormant Users"


def _numeric(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    return column if isinstance(df.schema[name].dataType, T.NumericType) else to_number(column)


def _filled(total: Column, zero: int | float) -> Column:
    """``zero`` in place of NULL and NaN."""
    return F.coalesce(F.when(~F.isnan(total), total), F.lit(zero))


def user_features(events: DataFrame) -> DataFrame:
    """Events, minutes and mean minutes per customer.

    Events are summed from the streams column when there is one, else counted. The
    group of events without a customer (NULL or NaN) becomes customer 0; unreadable
    keys drop. A NaN among a customer's values makes that sum or mean 0, as NULL does.
    """
    found = resolve_columns(
        events,
        {c: EVENT_ALIASES[c] for c in ("Customer_Key", "Minutes_Watched")},
        {"Streams_Count": EVENT_ALIASES["Streams_Count"]},
    )
    minutes = _numeric(found, "Minutes_Watched")
    if "Streams_Count" in found.columns:
        volume = _filled(F.sum(_numeric(found, "Streams_Count")), 0)
    else:
        volume = F.count("*")
    key_type = found.schema["Customer_Key"].dataType
    grouped = found.groupBy("Customer_Key").agg(
        volume.alias("total_eventos"),
        _filled(F.sum(minutes), 0).alias("total_minutos"),
        _filled(F.avg(minutes), 0.0).alias("promedio_minutos"),
    )
    missing = F.col("Customer_Key").isNull()
    if isinstance(key_type, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan("Customer_Key")
    key = F.when(missing, F.lit(0).cast("bigint")).otherwise(
        to_key(F.col("Customer_Key"), key_type)
    )
    return grouped.withColumn("Customer_Key", key).na.drop(subset=["Customer_Key"])


def standardized(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Add z_<feature> columns: mean 0, population deviation 1; constant features give 0."""
    features = features or FEATURES
    scale = df.agg(
        *[F.avg(f).alias(f"_m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"_s_{f}") for f in features],
    )
    z = {
        f"z_{f}": F.when(F.col(f"_s_{f}") > 0, (F.col(f) - F.col(f"_m_{f}")) / F.col(f"_s_{f}")).otherwise(0.0)
        for f in features
    }
    out = df
    for stat in scale.columns:
        out = out.withColumn(stat, scale.select(stat).scalar())
    return out.withColumns(z).drop(*scale.columns)


def scaled_vectors(features: DataFrame) -> DataFrame:
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_raw").transform(features)
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol="scaled")
    return scaler.fit(assembled).transform(assembled).drop("_raw")


def assign_clusters(
    features: DataFrame, k: int = CLUSTERS, seed: int = SEED, starts: int = STARTS
) -> DataFrame:
    """Add ``Cluster``: K-Means on scaled features, the best of several starts."""
    return cheapest_start(features, k, seed, starts)[0]


def cheapest_start(
    features: DataFrame, k: int = CLUSTERS, seed: int = SEED, starts: int = STARTS
) -> tuple[DataFrame, float]:
    """Users with the ``Cluster`` of the cheapest K-Means start, and its cost in sample deviations.

    The starts run at the same time over one cached table. The scaler divides by
    the sample deviation; that stretches every axis alike and moves no border.
    """
    scaled = scaled_vectors(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def fit(start: int):
            means = KMeans(
                k=k, seed=seed + start, maxIter=MAX_ITERATIONS, tol=1e-4, featuresCol="scaled", predictionCol="Cluster"
            )
            return means.fit(scaled)

        with ThreadPool(min(starts, 8)) as pool:
            models = pool.map(inheritable_thread_target(features.sparkSession)(fit), range(starts))
        best = min(models, key=lambda model: model.summary.trainingCost)
        return materialize(best.transform(scaled).drop("scaled"), "clusters"), best.summary.trainingCost
    finally:
        scaled.unpersist()


def cluster_means(assigned: DataFrame) -> DataFrame:
    """Size and feature means per cluster; the means are the centroids in original units."""
    return assigned.groupBy("Cluster").agg(
        F.count("*").alias("Usuarios"), *[F.avg(f).alias(f) for f in FEATURES]
    )


def cluster_labels(means: DataFrame) -> DataFrame:
    """Name each cluster by its mean activity: (Cluster, Cluster_Etiqueta).

    The windows are not partitioned; they span one row per cluster.
    """
    activity = F.round("total_eventos", 9)
    most = F.row_number().over(W.orderBy(F.desc("_activity"), "Cluster")) == 1
    least = F.row_number().over(W.orderBy("_activity", "Cluster")) == 1
    first_other = F.row_number().over(W.partitionBy("_extreme").orderBy("Cluster")) == 1
    return (
        means.select("Cluster", activity.alias("_activity"))
        .withColumns({"_most": most, "_least": least})
        .withColumn("_extreme", F.col("_most") | F.col("_least"))
        .withColumn("_first_other", first_other)
        .select(
            "Cluster",
            F.when(F.col("_most"), POWER)
            .when(F.col("_least"), DORMANT)
            .when(F.col("_first_other"), REGULAR)
            .otherwise(F.concat(F.lit("Cluster "), F.col("Cluster").cast("string")))
            .alias("Cluster_Etiqueta"),
        )
    )


def label_users(assigned: DataFrame) -> DataFrame:
    """Attach the label of each user's cluster; there is one label row per cluster."""
    labels = cluster_labels(cluster_means(assigned))
    return assigned.join(F.broadcast(labels), "Cluster").select(
        "Customer_Key", *FEATURES, "Cluster", "Cluster_Etiqueta"
    )


def segment_profile(assigned: DataFrame) -> DataFrame:
    """Size, share, feature means and z-scores of the means across clusters, least active first."""
    means = cluster_means(assigned)
    every = W.partitionBy()
    z = {
        f"z_{f}": F.round(
            F.coalesce(
                F.try_divide(F.col(f) - F.avg(f).over(every), F.nullif(F.stddev_pop(f).over(every), F.lit(0.0))),
                F.lit(0.0),
            ),
            6,
        )
        for f in FEATURES
    }
    share = F.round(F.col("Usuarios") / F.sum("Usuarios").over(every) * 100, 6)
    return (
        means.join(cluster_labels(means), "Cluster")
        .withColumns({"Porcentaje": share, **z})
        .withColumns({f: F.round(f, 6) for f in FEATURES})
        .orderBy("total_eventos", "Cluster")
    )


def inertia(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the own centroid, in standardized units."""
    z = standardized(assigned)
    squares = [
        F.sum(F.col(f"z_{f}") * F.col(f"z_{f}")) - F.pow(F.sum(f"z_{f}"), 2) / F.count("*") for f in FEATURES
    ]
    return z.groupBy("Cluster").agg(sum(squares[1:], squares[0]).alias("_within")).agg(
        F.round(F.sum("_within"), 6).alias("Inercia")
    )


class _Points:
    """A block of weighted points, sorted by cluster; ``ends`` tells where each cluster ends."""

    def __init__(self, ends: np.ndarray, *columns: np.ndarray):
        self.ends, self.axes, self.weight = ends, columns[:-1], columns[-1]

    def steps(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(cluster, from, to), at most ``size`` points each."""
        for cluster, (start, end) in enumerate(zip(np.r_[0, self.ends], self.ends)):
            for a in range(start, end, size):
                yield cluster, a, min(a + size, end)


def _add_distances(left: _Points, right: _Points, mine: np.ndarray, theirs: np.ndarray) -> None:
    """Add to ``mine`` every left point's summed distance to the right points of each cluster, and the
    other way round to ``theirs``, but once for a block with itself."""
    square, gap = np.empty((2, ROWS_PER_STEP * COLUMNS_PER_STEP))
    for p, a, b in left.steps(ROWS_PER_STEP):
        for q, c, d in right.steps(COLUMNS_PER_STEP):
            total, part = (x[: (b - a) * (d - c)].reshape(b - a, d - c) for x in (square, gap))
            for i, (x, y) in enumerate(zip(left.axes, right.axes)):
                to = part if i else total
                np.subtract(x[a:b, None], y[None, c:d], out=to)
                np.multiply(to, to, out=to)
                if i:
                    np.add(total, part, out=total)
            np.sqrt(total, out=total)
            mine[a:b, q] += total @ right.weight[c:d]
            if left is not right:
                theirs[c:d, p] += left.weight[a:b] @ total


def silhouette(assigned: DataFrame) -> DataFrame:
    """Mean silhouette with Euclidean distance, exact.

    Equal points are merged with a weight first. Points are hashed into blocks, and these
    stored once as packed arrays. A task reads two stretches of blocks and sends back, for each
    of their points, only its summed distance to each cluster, packed again. Quadratic in the
    distinct points; see ``squared_silhouette`` for the linear variant.
    """
    spark = assigned.sparkSession
    axes = [f"z_{f}" for f in FEATURES]
    z = standardized(assigned).select(*axes, F.col("Cluster").cast("int").alias("Cluster"))
    points = materialize(z.groupBy(*axes, "Cluster").agg(F.count("*").alias("_weight")), "points")
    found = points.groupBy("Cluster").agg(F.count("*").alias("points"), F.sum("_weight").alias("size")).collect()
    known = sorted((r for r in found if r["Cluster"] is not None), key=lambda r: r["Cluster"])
    names, sizes = [r["Cluster"] for r in known], np.array([r["size"] for r in known], dtype=np.float64)
    everyone = sum(r["size"] for r in found)  # users without a cluster count, with 0
    count, tasks = sum(r["points"] for r in known), cores(spark)
    blocks = busy_blocks(blocks_for(count, ROWS_PER_BLOCK), count, COLUMNS_PER_STEP, tasks)
    stretches, blocks = dealt(blocks, BLOCKS_PER_STRETCH, tasks)
    binaries = ["ends", *[f"c{i}" for i in range(len(axes) + 1)]]

    def pack(table: pa.Table) -> pa.Table:
        cluster = np.searchsorted(names, table["Cluster"].to_numpy())
        by = np.argsort(cluster, kind="stable")
        ends = np.cumsum(np.bincount(cluster, minlength=len(names)))
        arrays = [ends.astype(np.int64), *[table[c].to_numpy().astype(np.float64)[by] for c in (*axes, "_weight")]]
        packed = {c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(binaries, arrays)}
        return pa.table({"block": table["_block"].combine_chunks()[:1]} | packed)

    def read(buffers: list[bytes]) -> _Points:
        return _Points(np.frombuffer(buffers[0], np.int64), *[np.frombuffer(x) for x in buffers[1:]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = held_blocks(batches, binaries, read)
        sums = {n: np.zeros((len(block.weight), len(names))) for n, block in held.items()}
        for lo, hi in pairs:
            _add_distances(held[lo], held[hi], sums[lo], sums[hi])
        for n, block in held.items():
            packed = {k: pa.array([x.tobytes()], pa.binary()) for k, x in zip(("ends", "weight", "sums"), (block.ends, block.weight, sums[n]))}
            yield pa.record_batch({"block": pa.array([n], pa.int32())} | packed)

    def score(table: pa.Table) -> pa.Table:
        """The summed score of a block's points; 0 for one alone in its cluster, or without another cluster."""
        ends, weight = (np.frombuffer(table[c][0].as_py(), t) for c, t in (("ends", np.int64), ("weight", np.float64)))
        total = sum(np.frombuffer(x.as_py()) for x in table["sums"]).reshape(len(weight), len(names))
        cluster = np.repeat(np.arange(len(names)), np.diff(np.r_[0, ends]))
        own = np.arange(len(names)) == cluster[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            a = total[own] / (sizes[cluster] - 1)
            b = np.where(own, np.inf, total / sizes).min(axis=1)
            value = (b - a) / np.maximum(a, b)
        value = np.where((sizes[cluster] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0), value, 0.0)
        return pa.table({"score": [float(value @ weight)]})

    packed = materialize(
        points.filter(F.col("Cluster").isNotNull())
        .withColumn("_block", F.pmod(F.xxhash64(*axes, "Cluster"), F.lit(blocks)).cast("int"))
        .repartition(min(blocks, MAX_TASKS), "_block")
        .groupBy("_block")
        .applyInArrow(pack, "block INT, " + ", ".join(f"{c} BINARY" for c in binaries)),
        "point-blocks",
    )
    scores = (
        stretch_pairs(packed, stretches, blocks)
        .mapInArrow(task, "block INT, ends BINARY, weight BINARY, sums BINARY")
        .groupBy("block")
        .applyInArrow(score, "score DOUBLE")
    )
    total = F.coalesce(F.sum("score"), F.lit(0.0)) if everyone else F.sum("score")
    return scores.agg(F.round(total / F.lit(everyone or None), 6).alias("Silhouette"))


def squared_silhouette(assigned: DataFrame) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, linear in the users. Its value
    is not comparable with the Euclidean one."""
    vectors = scaled_vectors(assigned)
    value = ClusteringEvaluator(featuresCol="scaled", predictionCol="Cluster").evaluate(vectors)
    return assigned.sparkSession.range(1).select(F.lit(round(value, 6)).alias("Silhouette_Cuadrado"))


def certify(assigned: DataFrame, cost: float, slack: float = 0.01) -> DataFrame:
    """What must hold for K-Means segments, told for every user.

    ``Nearest``: no centroid is nearer than the own one by more than ``slack`` standard
    deviations, which K-Means leaves open when it stops. ``Named``: the label fits the mean
    activity of the user's cluster among all. ``Cheapest``: the squared distances to the
    centroids sum to no more than ``cost``, that of the cheapest start. The centroids,
    one per cluster, come in as a one-row subquery.
    """
    axes = [f"z_{f}" for f in FEATURES]
    users = standardized(label_users(assigned))
    centroids = users.groupBy("Cluster").agg(
        F.count("*").alias("size"), F.round(F.avg("total_eventos"), 9).alias("activity"), *[F.avg(a).alias(a) for a in axes]
    )
    listed = centroids.agg(F.collect_list(F.struct(*centroids.columns)).alias("centroids"))

    def gap(centroid: Column) -> Column:
        squares = [(F.col(a) - centroid[a]) * (F.col(a) - centroid[a]) for a in axes]
        return F.sqrt(sum(squares[1:], squares[0]))

    activities = F.transform("_centroids", lambda c: c["activity"])
    label = F.col("Cluster_Etiqueta")
    told = users.withColumn("_centroids", listed.scalar()).withColumn(
        "_own", F.filter("_centroids", lambda c: c["Cluster"] == F.col("Cluster"))[0]
    )
    # the cost is in sample deviations, the axes in population deviations
    users_now = F.aggregate("_centroids", F.lit(0).cast("bigint"), lambda n, c: n + c["size"])
    within = inertia(assigned).select("Inercia").scalar() * (users_now - 1) / users_now
    return told.select(
        "Customer_Key",
        *FEATURES,
        (gap(F.col("_own")) <= F.array_min(F.transform("_centroids", gap)) + slack).alias("Nearest"),
        (
            F.when(label == POWER, F.col("_own.activity") >= F.array_max(activities))
            .when(label == DORMANT, F.col("_own.activity") <= F.array_min(activities))
            .otherwise(F.col("_own.activity").between(F.array_min(activities), F.array_max(activities)))
        ).alias("Named"),
        (within <= F.lit(cost * (1 + 1e-6) + 1e-6)).alias("Cheapest"),
    )


def segment_users(events: DataFrame) -> DataFrame:
    """Features, K-Means and labels, sorted by cluster and customer."""
    features = materialize(require_rows(user_features(events), "user features"), "features")
    return label_users(assign_clusters(features)).orderBy("Cluster", "Customer_Key")

"""User segmentation. The clusters K-Means finds have no SQL; everything that
follows from a given assignment has, here with each customer's region as cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.operators import segmentation as seg
from cinelake.plans import registry
from cinelake.session import materialize
from cinelake.sources.retail_star import RetailStar
from conformance import case
from conformance.star_sql import with_tables


@case(
    "m1_user_features",
    with_tables(
        "viewing",
        """SELECT u AS "Customer_Key", count(*) AS total_eventos, round(sum(m), 6) AS total_minutos,
        round(avg(m), 6) AS promedio_minutos FROM viewing GROUP BY u""",
    ),
)
def m1(spark, directory) -> DataFrame:
    features = seg.user_features(RetailStar(spark, directory).viewing())
    return features.withColumns({c: F.round(c, 6) for c in ("total_minutos", "promedio_minutos")})


@case(
    "m1_a6_user_features_from_streams",
    with_tables(
        "event",
        """SELECT "Customer Key" AS "Customer_Key", CAST(sum("Streams Count") AS BIGINT) AS total_eventos,
        CAST(sum("Minutes Watched") AS BIGINT) AS total_minutos, round(avg("Minutes Watched"), 6) AS promedio_minutos
        FROM event GROUP BY 1""",
    ),
)
def m1_streams(spark, directory) -> DataFrame:
    features = seg.user_features(RetailStar(spark, directory).event())
    return features.withColumn("promedio_minutos", F.round("promedio_minutos", 6))


_FEATURES = """
    WITH assigned AS (
      SELECT o_custkey AS k, n_regionkey AS c, count(*) AS total_eventos,
             CAST(sum(floor(o_totalprice)) AS BIGINT) AS total_minutos, avg(floor(o_totalprice)) AS promedio_minutos
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    z AS (
      SELECT k, c, (total_eventos - avg(total_eventos) OVER ()) / stddev_pop(total_eventos) OVER () AS z1,
             (total_minutos - avg(total_minutos) OVER ()) / stddev_pop(total_minutos) OVER () AS z2,
             (promedio_minutos - avg(promedio_minutos) OVER ()) / stddev_pop(promedio_minutos) OVER () AS z3
      FROM assigned),
    means AS (
      SELECT c, count(*) AS n, avg(total_eventos) AS e, avg(total_minutos) AS m, avg(promedio_minutos) AS p
      FROM assigned GROUP BY c),
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY round(e, 9) DESC, c) = 1 AS most,
             row_number() OVER (ORDER BY round(e, 9), c) = 1 AS least FROM means),
    labels AS (
      SELECT c, CASE WHEN most THEN 'Power Users' WHEN least THEN 'Dormant Users'
                     WHEN row_number() OVER (PARTITION BY most OR least ORDER BY c) = 1 THEN 'Regular Users'
                     ELSE 'Cluster ' || c END AS label
      FROM ranked)
"""


def by_region(spark, directory) -> DataFrame:
    """Order features per customer with the customer's region as cluster."""
    star = RetailStar(spark, directory)
    orders = star.raw("orders").select(
        F.col("o_custkey").alias("customer_key"), F.floor("o_totalprice").alias("minutes_watched")
    )
    regions = star.raw("customer").join(star.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("Customer_Key"), F.col("n_regionkey").alias("Cluster")
    )
    return materialize(seg.user_features(orders).join(regions, "Customer_Key"), "by-region")


@case("m4_cluster_labels", _FEATURES + 'SELECT c AS "Cluster", label AS "Cluster_Etiqueta" FROM labels')
def m4(spark, directory) -> DataFrame:
    return seg.cluster_labels(seg.cluster_means(by_region(spark, directory)))


@case(
    "m4_labelled_users",
    _FEATURES + """SELECT k AS "Customer_Key", total_eventos, total_minutos,
    round(promedio_minutos, 6) AS promedio_minutos, assigned.c AS "Cluster", label AS "Cluster_Etiqueta"
    FROM assigned JOIN labels ON labels.c = assigned.c""",
)
def m4_users(spark, directory) -> DataFrame:
    users = seg.label_users(by_region(spark, directory))
    return users.withColumn("promedio_minutos", F.round("promedio_minutos", 6))


@case(
    "m5_a7_t6_centroids",
    _FEATURES + """SELECT c AS "Cluster", n AS "Usuarios", round(e, 6) AS total_eventos, round(m, 6) AS total_minutos,
    round(p, 6) AS promedio_minutos FROM means""",
)
def m5(spark, directory) -> DataFrame:
    means = seg.cluster_means(by_region(spark, directory))
    return means.withColumns({f: F.round(f, 6) for f in seg.FEATURES}).orderBy("total_eventos")


@case(
    "m2_standardized_features",
    _FEATURES + """SELECT k AS "Customer_Key", round(z1, 6) AS z_total_eventos, round(z2, 6) AS z_total_minutos,
    round(z3, 6) AS z_promedio_minutos FROM z""",
)
def m2(spark, directory) -> DataFrame:
    z = seg.standardized(by_region(spark, directory))
    return z.select("Customer_Key", *[F.round(f"z_{f}", 6).alias(f"z_{f}") for f in seg.FEATURES])


@case(
    "m6_silhouette",
    _FEATURES + """, near AS (
      SELECT x.k, x.c, y.c AS o, sum(sqrt((x.z1 - y.z1) ** 2 + (x.z2 - y.z2) ** 2 + (x.z3 - y.z3) ** 2)) AS d
      FROM z x CROSS JOIN z y GROUP BY 1, 2, 3),
    sizes AS (SELECT c AS o, count(*) AS size FROM z GROUP BY 1),
    ab AS (
      SELECT k, max(CASE WHEN c = near.o THEN d / (size - 1) END) AS a, min(CASE WHEN c <> near.o THEN d / size END) AS b
      FROM near JOIN sizes ON sizes.o = near.o GROUP BY k)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS "Silhouette" FROM ab""",
)
def m6(spark, directory) -> DataFrame:
    return seg.silhouette(by_region(spark, directory))


@case(
    "m6_squared_silhouette",
    _FEATURES + """, sums AS (
      SELECT c AS o, count(*) AS n, sum(z1) AS s1, sum(z2) AS s2, sum(z3) AS s3, sum(z1 * z1 + z2 * z2 + z3 * z3) AS q
      FROM z GROUP BY 1),
    near AS (
      SELECT k, c, o, n, n * (z1 * z1 + z2 * z2 + z3 * z3) + q - 2 * (z1 * s1 + z2 * s2 + z3 * s3) AS d
      FROM z CROSS JOIN sums),
    ab AS (
      SELECT k, max(CASE WHEN c = o THEN d / (n - 1) END) AS a, min(CASE WHEN c <> o THEN d / n END) AS b
      FROM near GROUP BY k)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS "Silhouette_Cuadrado" FROM ab""",
)
def m6_squared(spark, directory) -> DataFrame:
    return seg.squared_silhouette(by_region(spark, directory))


@case(
    "m7_inertia",
    _FEATURES + """SELECT round(sum((z1 - a1) ** 2 + (z2 - a2) ** 2 + (z3 - a3) ** 2), 6) AS "Inercia" FROM (
      SELECT *, avg(z1) OVER (PARTITION BY c) AS a1, avg(z2) OVER (PARTITION BY c) AS a2,
             avg(z3) OVER (PARTITION BY c) AS a3 FROM z)""",
)
def m7(spark, directory) -> DataFrame:
    return seg.inertia(by_region(spark, directory))


@case(
    "m8_w4_segment_profile",
    _FEATURES + """SELECT means.c AS "Cluster", n AS "Usuarios", label AS "Cluster_Etiqueta", round(e, 6) AS total_eventos,
    round(m, 6) AS total_minutos, round(p, 6) AS promedio_minutos, round(n / sum(n) OVER () * 100, 6) AS "Porcentaje",
    round((e - avg(e) OVER ()) / stddev_pop(e) OVER (), 6) AS z_total_eventos,
    round((m - avg(m) OVER ()) / stddev_pop(m) OVER (), 6) AS z_total_minutos,
    round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS z_promedio_minutos
    FROM means JOIN labels ON labels.c = means.c""",
)
def m8(spark, directory) -> DataFrame:
    return seg.segment_profile(by_region(spark, directory))


@case("q10_user_segments")
def q10(spark, directory) -> DataFrame:
    return registry.MODELS["user_segments"](RetailStar(spark, directory))


@case(
    "m3_q10_certified_segments",
    with_tables(
        "viewing",
        """SELECT u AS "Customer_Key", count(*) AS total_eventos, round(sum(m), 6) AS total_minutos,
        round(avg(m), 6) AS promedio_minutos, TRUE AS "Nearest", TRUE AS "Named", TRUE AS "Cheapest"
        FROM viewing GROUP BY u""",
    ),
)
def m3_certified(spark, directory) -> DataFrame:
    """The users of K-Means segments with what must hold for each."""
    features = materialize(seg.user_features(RetailStar(spark, directory).viewing()), "features")
    told = seg.certify(*seg.cheapest_start(features))
    return told.withColumns({c: F.round(c, 6) for c in ("total_minutos", "promedio_minutos")})


@case("m3_kmeans_quality")
def m3(spark, directory) -> DataFrame:
    """Profile of the segments K-Means finds, with inertia and silhouette."""
    assigned = seg.assign_clusters(
        materialize(seg.user_features(RetailStar(spark, directory).viewing()), "features")
    )
    quality = seg.inertia(assigned).first()["Inercia"], seg.silhouette(assigned).first()["Silhouette"]
    return seg.segment_profile(assigned).withColumns(
        {"Inercia": F.lit(quality[0]), "Silhouette": F.lit(quality[1])}
    )

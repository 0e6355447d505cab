import numpy as np
import pytest

from cinelake.operators import segmentation as seg

SCHEMA = "Customer_Key BIGINT, total_eventos BIGINT, total_minutos DOUBLE, promedio_minutos DOUBLE, Cluster INT"


def test_missing_customer_becomes_zero_beside_a_real_zero(spark, rows):
    events = spark.createDataFrame(
        [(None, 10.0), (None, 20.0), (0, 5.0), (1, None)], "`Customer Key` BIGINT, `Minutes Watched` DOUBLE"
    )
    got = sorted(rows(seg.user_features(events)))
    assert got == [(0, 1, 5.0, 5.0), (0, 2, 30.0, 15.0), (1, 1, 0.0, 0.0)]


def test_nan_counts_as_missing(spark, rows):
    nan = float("nan")
    events = spark.createDataFrame(
        [(nan, 3.0), (1.0, 4.0), (1.0, nan), (2.0, 6.0)], "`Customer Key` DOUBLE, `Minutes Watched` DOUBLE"
    )
    assert sorted(rows(seg.user_features(events))) == [(0, 1, 3.0, 3.0), (1, 2, 0.0, 0.0), (2, 1, 6.0, 6.0)]


def test_text_keys_and_streams(spark, rows):
    events = spark.createDataFrame(
        [("a", 1.0, 3), ("2", 4.0, 5), ("2", 6.0, None)], "customer_key STRING, minutesWatched DOUBLE, Streams_Count BIGINT"
    )
    assert rows(seg.user_features(events)) == [(2, 5, 10.0, 5.0)]


@pytest.mark.parametrize(
    "means,expected",
    [
        ({0: 5.0}, {0: "Power Users"}),
        ({0: 5.0, 1: 9.0}, {0: "Dormant Users", 1: "Power Users"}),
        ({0: 5.0, 1: 9.0, 2: 1.0}, {0: "Regular Users", 1: "Power Users", 2: "Dormant Users"}),
        ({0: 5.0, 1: 9.0, 2: 1.0, 3: 4.0}, {0: "Regular Users", 1: "Power Users", 2: "Dormant Users", 3: "Cluster 3"}),
        ({0: 9.0, 1: 9.0, 2: 1.0, 3: 1.0}, {0: "Power Users", 1: "Regular Users", 2: "Dormant Users", 3: "Cluster 3"}),
        ({0: 2.0, 1: 2.0}, {0: "Power Users", 1: "Regular Users"}),
    ],
)
def test_labels(spark, means, expected):
    df = spark.createDataFrame(list(means.items()), "Cluster INT, total_eventos DOUBLE")
    assert {r[0]: r[1] for r in seg.cluster_labels(df).collect()} == expected


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 10, 5.0, 1.0, 0), (2, 20, 5.0, 2.0, 0)], SCHEMA)
    got = seg.standardized(df).orderBy("Customer_Key").collect()
    assert [(r["z_total_eventos"], r["z_total_minutos"]) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]
    profile = seg.segment_profile(df).first()
    assert (profile["z_total_eventos"], profile["Porcentaje"]) == (0.0, 100.0)


def three_groups(users=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(users):
        level = (10, 60, 200)[k % 3]
        events = int(level + rng.integers(-3, 4))
        minutes = float(np.round(events * (10 + level / 20 + rng.uniform(-0.2, 0.2)), 1))
        rows.append((k, events, minutes, minutes / events, k % 3))
    return rows


def brute_silhouette(points, clusters):
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(clusters):
        own = clusters == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = gaps[i, own].sum() / (own.sum() - 1)
        b = min(gaps[i, clusters == o].mean() for o in set(clusters) - {c})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block", [512, 9])
def test_silhouette_and_inertia_against_numpy(spark, monkeypatch, block):
    rng = np.random.default_rng(11)
    rows = [(k, e, m, p, int(rng.integers(0, 3))) for k, e, m, p, _ in three_groups(50)]
    rows += [(100 + k, *rows[0][1:]) for k in range(5)]  # copies of one user
    rows += [(200, 500, 1.0, 1.0, 7)]  # a cluster of one
    df = spark.createDataFrame(rows, SCHEMA)
    values = np.array([r[1:4] for r in rows], dtype=float)
    z = (values - values.mean(axis=0)) / values.std(axis=0)
    clusters = np.array([r[4] for r in rows])
    monkeypatch.setattr(seg, "ROWS_PER_BLOCK", block)
    assert seg.silhouette(df).first()[0] == pytest.approx(brute_silhouette(z, clusters), abs=1e-6)
    within = sum(((z[clusters == c] - z[clusters == c].mean(axis=0)) ** 2).sum() for c in set(clusters))
    assert seg.inertia(df).first()[0] == pytest.approx(within, abs=1e-5)


def test_kmeans_finds_clear_groups(spark):
    rows = three_groups()
    df = spark.createDataFrame(rows, SCHEMA).drop("Cluster")
    assigned = seg.assign_clusters(df)
    labels = {r["Customer_Key"]: r["Cluster_Etiqueta"] for r in seg.label_users(assigned).collect()}
    names = ("Dormant Users", "Regular Users", "Power Users")
    assert labels == {k: names[group] for k, *_, group in rows}
    assert seg.silhouette(assigned).first()[0] > 0.6


def test_segments_are_sorted(spark):
    events = spark.createDataFrame(
        [(k, float(m)) for k, events, m, *_ in three_groups(15) for _ in range(events // 10 + 1)],
        "customerKey BIGINT, minutes_watched DOUBLE",
    )
    got = [(r["Cluster"], r["Customer_Key"]) for r in seg.segment_users(events).collect()]
    assert got == sorted(got) and len(got) == 15


def test_no_events_is_an_error(spark):
    with pytest.raises(RuntimeError):
        seg.segment_users(spark.createDataFrame([], "customerKey BIGINT, minutes_watched DOUBLE"))


def test_silhouette_copies_no_point_per_block(spark, monkeypatch):
    """Points go through shuffles once as packed blocks, and users without a cluster count with 0."""
    rng = np.random.default_rng(13)
    values = rng.normal(size=(90, 3)).round(2) * 100
    rows = [(k, int(v[0]), float(v[1]), float(v[2]), int(k % 4) if k % 9 else None) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(seg, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(seg, "BLOCKS_PER_STRETCH", 3)
    found = seg.silhouette(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "inline" in plan and "explode" not in plan and "CartesianProduct" not in plan
    given = np.array([r[1:4] for r in rows])
    z = (given - given.mean(axis=0)) / given.std(axis=0)
    known = np.array([r[4] is not None for r in rows])
    score = brute_silhouette(z[known], np.array([r[4] for r in rows if r[4] is not None]))
    assert found.first()[0] == pytest.approx(score * known.sum() / len(rows), abs=1e-6)

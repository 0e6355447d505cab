"""Recommenders against a plain numpy computation on small random matrices."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinelake.operators import metrics, pairwise, recommend, similarity, tfidf
from cinelake.operators.matrix import build_matrix, popularity, sparsity, user_means, wide
from cinelake.plans import recommendations as plans

EVENTS = "`Customer Key` BIGINT, `Content Key` BIGINT, `Minutes Watched` DOUBLE"


def events_of(spark, dense, touched=None):
    """Events for a matrix of minutes; ``touched`` marks cells present with 0 minutes."""
    touched = np.zeros_like(dense, dtype=bool) if touched is None else touched
    rows = [
        (int(u), int(i), float(dense[u, i]))
        for u, i in zip(*np.nonzero((dense > 0) | touched))
    ]
    return spark.createDataFrame(rows, EVENTS)


def random_matrix(seed, users=20, items=20, density=0.3):
    rng = np.random.default_rng(seed)
    dense = np.round(rng.uniform(1, 120, (users, items)), 1) * (rng.random((users, items)) < density)
    touched = np.zeros_like(dense, dtype=bool)
    touched[np.arange(users), rng.integers(0, items, users)] = True
    touched[rng.integers(0, users, items), np.arange(items)] = True
    return dense, touched


def cosine(rows):
    norm = np.sqrt((rows * rows).sum(axis=1))
    norm[norm == 0] = 1
    unit = rows / norm[:, None]
    return np.round(np.clip(unit @ unit.T, -1, 1), 9)


def centre(dense):
    seen = dense > 0
    counts = seen.sum(axis=1)
    means = np.divide(dense.sum(axis=1), counts, out=np.zeros(len(dense)), where=counts > 0)
    return np.round(np.where(seen, dense - means[:, None], 0), 9)


def novelty(minutes):
    return 1.25 if minutes == 0 else 1.12 if minutes < 30 else 1.0 if minutes <= 90 else 0.65


def finish(scored, dense, user):
    """Fallback and top ten for one user; ``scored`` is {item: score} in key order."""
    entries = [(-s, 0, i, i) for i, s in scored.items()]
    if len(scored) < 10:
        popular = np.round(dense.mean(axis=0), 9)
        order = sorted(range(dense.shape[1]), key=lambda i: (-popular[i], i))
        for position, item in enumerate(i for i in order if i not in scored):
            if len(entries) >= 30:
                break
            entries.append((-round(popular[item] * novelty(dense[user, item]), 9), 1, position, item))
    return [(item, -down) for down, _, _, item in sorted(entries)[:10]]


def by_users(dense):
    sims = np.maximum(cosine(centre(dense)), 0)
    out = {}
    for u in range(len(dense)):
        others = sorted((v for v in range(len(dense)) if v != u), key=lambda v: (-sims[u, v], v))[:20]
        scored = {}
        if dense[u].sum() >= 50 and others:
            for item in range(dense.shape[1]):
                viewers = [v for v in others if dense[v, item] > 0]
                weight = sum(sims[u, v] for v in viewers)
                if len(viewers) >= 3 and weight > 0:
                    base = sum(sims[u, v] * dense[v, item] for v in viewers) / weight
                    scored[item] = round(base * novelty(dense[u, item]), 9)
        out[u] = finish(scored, dense, u)
    return out


def by_items(dense, sims):
    out = {}
    for u in range(len(dense)):
        scored = {}
        for item in range(dense.shape[1]):
            near = [i for i in range(dense.shape[1]) if i != item and dense[u, i] > 0 and sims[item, i] > 0]
            near = sorted(near, key=lambda i: (-sims[item, i], i))[:15]
            if near:
                weight = sum(sims[item, i] for i in near)
                base = sum(sims[item, i] * dense[u, i] for i in near) / weight
                scored[item] = round(base * novelty(dense[u, item]), 9)
        out[u] = finish(scored, dense, u)
    return out


def lists_of(df):
    out = {}
    for r in df.orderBy("Customer_Key", "Rank").collect():
        out.setdefault(r["Customer_Key"], []).append((r["Content_Key"], r["Score"]))
    return out


def assert_same_lists(got, expected):
    assert set(got) == set(expected)
    for user, entries in expected.items():
        assert [i for i, _ in got[user]] == [i for i, _ in entries], user
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in entries], abs=1e-7)


@pytest.mark.parametrize("seed,users,density", [(1, 20, 0.3), (2, 26, 0.12), (3, 4, 0.5), (4, 23, 0.6)])
def test_user_user_against_brute_force(spark, seed, users, density):
    dense, touched = random_matrix(seed, users=users, density=density)
    matrix = build_matrix(events_of(spark, dense, touched))
    assert (matrix.users, matrix.items) == dense.shape
    assert_same_lists(lists_of(plans.user_user(matrix)), by_users(dense))


@pytest.mark.parametrize("seed,density", [(5, 0.3), (6, 0.1)])
def test_item_item_against_brute_force(spark, seed, density):
    dense, touched = random_matrix(seed, density=density)
    matrix = build_matrix(events_of(spark, dense, touched))
    sims = cosine(centre(dense).T)
    assert_same_lists(lists_of(plans.item_item(matrix)), by_items(dense, sims))


def test_small_blocks_give_the_same_result(spark, monkeypatch):
    dense, touched = random_matrix(7, users=30)
    matrix = build_matrix(events_of(spark, dense, touched))
    units = similarity.centred_user_units(matrix)

    def summary():
        best = sorted(map(tuple, pairwise.top_positive(units, matrix.users, matrix.cell_count, 5).collect()))
        items = sorted(map(tuple, similarity.item_pairs(matrix).collect()))
        return best, items, pairwise.pair_statistics(units, matrix.users, matrix.cell_count).collect(), pairwise.pair_histogram(
            units, matrix.users, matrix.cell_count, 35
        ).collect()

    whole = summary()
    monkeypatch.setattr(pairwise, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(pairwise, "ROWS_PER_TILE", 3)
    monkeypatch.setattr(pairwise, "CELLS_PER_BLOCK", 40)
    split = summary()
    assert split[0] == whole[0] and split[2:] == whole[2:]
    assert [p[:2] for p in split[1]] == [p[:2] for p in whole[1]]
    assert [p[2] for p in split[1]] == pytest.approx([p[2] for p in whole[1]], abs=2e-9)


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("density", [0.0, 0.05, 0.5])
def test_block_products(monkeypatch, same, density):
    """Dense and sparse products, in small steps, against one matrix product."""
    rng = np.random.default_rng(12)
    full = rng.normal(size=(30, 50)) * (rng.random((30, 50)) < density)
    row, feature = np.nonzero(full)
    part = pd.DataFrame(
        {"row": row * 3, "feature": feature * 7, "value": full[row, feature], "_block": 0 if same else row % 2}
    )
    monkeypatch.setattr(pairwise, "FEATURES_PER_STEP", 6)
    monkeypatch.setattr(pairwise, "PRODUCTS_PER_STEP", 11)
    monkeypatch.setattr(pairwise, "ROWS_PER_TILE", 4)
    for cost in (0, 10**9):
        monkeypatch.setattr(pairwise, "SPARSE_COST", cost)
        pairs = 0
        for left, right, product in pairwise._products(part, 0, 0 if same else 1):
            a, b = left.cells[0], right.cells[0]
            assert product == pytest.approx(full[a // 3] @ full[b // 3].T)
            # no product exceeds the bound that the groups of features give
            assert (np.abs(product) <= left.bounds @ right.bounds + 1e-9).all()
            pairs += len(a) * (len(a) + 1) // 2 if left is right else len(a) * len(b)
        rows = len({r for r in row if same or r % 2 == 0})
        assert pairs == (rows * (rows + 1) // 2 if same else rows * len({r for r in row if r % 2}))


def test_tiles_that_cannot_reach_a_list_are_skipped(monkeypatch):
    """Five flocks of users, each with a favourite content: rows of a flock are alike, those of others are not."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(pairwise, "ROWS_PER_TILE", 20)
    full = np.zeros((100, 40))
    for r in range(100):
        full[r, 8 * (r % 5) : 8 * (r % 5) + 8] = rng.uniform(1, 2, 8)
        full[r, 8 * (r % 5)] = 9
        full[r, (8 * (r % 5) + 11) % 40] = 0.1
    full /= np.sqrt((full * full).sum(axis=1))[:, None]
    row, feature = np.nonzero(full)
    part = pd.DataFrame({"row": row, "feature": feature, "value": full[row, feature], "_block": 0})
    monkeypatch.setattr(pairwise, "GROUPS", 2048)
    found, skipped = pairwise.best_of_blocks(part, 0, 0, 3)
    sims = np.round(np.clip(full @ full.T, -1, 1), 9)
    np.fill_diagonal(sims, 0)
    expected = [(r, c, sims[r, c]) for r in range(100) for c in sorted(range(100), key=lambda c: (-sims[r, c], c))[:3]]
    got = found.sort_values(["row", "similarity", "other"], ascending=[True, False, True])
    assert [(a, b) for a, b, _ in got.itertuples(index=False)] == [(a, b) for a, b, _ in expected]
    assert skipped >= 8


@pytest.mark.parametrize("rows, cells, tasks", [(1500, 73_000, 8), (10**8, 10**10, 1000), (3, 9, 8), (0, 0, 8), (10**6, 10**9, 64)])
def test_copies_of_a_cell_are_bounded(rows, cells, tasks):
    blocks = pairwise.row_blocks_for(rows, cells, tasks)
    assert blocks * (blocks + 1) // 2 >= min(tasks, rows * (rows + 1) // 2)
    by_size = max(-(-rows // pairwise.ROWS_PER_BLOCK), -(-cells // pairwise.CELLS_PER_BLOCK), 1)
    assert blocks <= max(by_size, (2 * tasks) ** 0.5 + 1)


def test_copies_in_the_plan(spark):
    dense, touched = random_matrix(7, users=30)
    matrix = build_matrix(events_of(spark, dense, touched))
    units = similarity.centred_user_units(matrix)
    blocks = pairwise.row_blocks_for(matrix.users, matrix.cell_count, 8)
    assert pairwise.block_pairs(units, "row", blocks).count() == blocks * units.count()
    plan = pairwise.top_positive(units, matrix.users, matrix.cell_count, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_merged_lists_of_item_tiles(spark, monkeypatch):
    """Partial lists of several tiles and steps give the same scores as one."""
    dense, touched = random_matrix(17, users=25, items=24, density=0.5)
    matrix = build_matrix(events_of(spark, dense, touched))
    monkeypatch.setattr(recommend, "NEAR_PER_TILE", 30)
    monkeypatch.setattr(recommend, "CELLS_PER_BLOCK", 50)
    monkeypatch.setattr(recommend, "OFFERS_PER_STEP", 20)
    assert_same_lists(lists_of(plans.item_item(matrix)), by_items(dense, cosine(centre(dense).T)))


def test_fillers_are_no_join_rows(spark):
    """Fillers count as viewers although only positive neighbours are asked."""
    for seed in (21, 22, 23):
        dense, touched = random_matrix(seed, users=24, items=8, density=0.2)
        matrix = build_matrix(events_of(spark, dense, touched))
        positive = recommend.positive_users(matrix)
        assert positive.filter("similarity <= 0").count() == 0
        scored = recommend.score_by_users(matrix, positive).collect()
        whole = recommend.score_by_users(matrix, recommend.similar_users(matrix)).collect()
        assert sorted(map(tuple, scored)) == sorted(map(tuple, whole))
        assert_same_lists(lists_of(plans.user_user(matrix)), by_users(dense))


def test_a_hot_content_leaves_no_pairs_in_the_shuffle(spark):
    """All users share one content; the tasks still send back k rows per user and block."""
    dense = np.zeros((40, 3))
    dense[:, 0] = np.arange(1, 41)
    dense[:, 1] = 5
    matrix = build_matrix(events_of(spark, dense))
    best = pairwise.top_positive(similarity.raw_user_units(matrix), matrix.users, matrix.cell_count, 4)
    assert best.count() == 40 * 4


def test_statistics_count_pairs_that_share_nothing(spark):
    dense = np.array([[10, 20, 0, 0], [20, 10, 0, 0], [0, 0, 5, 9], [7, 7, 0, 0]], dtype=float)
    matrix = build_matrix(events_of(spark, dense))
    values = cosine(centre(dense))[np.triu_indices(4, k=1)]
    got = pairwise.pair_statistics(similarity.centred_user_units(matrix), matrix.users, matrix.cell_count).first()
    assert got["Pairs"] == 6
    assert (got["Mean"], got["Std"]) == pytest.approx((values.mean(), values.std()), abs=1e-6)
    assert (got["Min"], got["Max"]) == (values.min(), values.max())
    items = cosine(centre(dense).T)[np.triu_indices(4, k=1)]
    got = pairwise.pair_list_statistics(similarity.item_pairs(matrix), matrix.items).first()
    assert (got["Mean"], got["Min"], got["Max"]) == pytest.approx((items.mean(), items.min(), items.max()), abs=1e-6)


def test_one_user_has_no_pairs(spark):
    matrix = build_matrix(events_of(spark, np.array([[60.0, 10.0]])))
    got = pairwise.pair_statistics(similarity.centred_user_units(matrix), matrix.users, matrix.cell_count).first()
    assert tuple(got) == (0, 0.0, 0.0, 0.0, 0.0)
    assert recommend.similar_users(matrix).count() == 0
    assert lists_of(plans.user_user(matrix)) == {0: [(0, 60.0), (1, round(10 * 1.12, 9))]}


def test_fifty_minutes_are_needed_for_scores(spark):
    dense = np.zeros((6, 12))
    dense[:4] = np.arange(1, 13) * 3.0
    dense[1:4] += np.array([[1], [2], [3]])
    dense[4, :2] = (24, 25)
    dense[5, :2] = (10, 40)
    matrix = build_matrix(events_of(spark, dense))
    scored = recommend.score_by_users(matrix, recommend.similar_users(matrix))
    users = {r[0] for r in scored.select("Customer_Key").distinct().collect()}
    assert 4 not in users and 5 in users
    assert_same_lists(lists_of(plans.user_user(matrix)), by_users(dense))


def test_matrix_sizes_count_untouched_cells(spark):
    dense = np.array([[0, 10, 0], [0, 0, 0]], dtype=float)
    touched = np.array([[True, False, False], [False, False, True]])
    matrix = build_matrix(events_of(spark, dense, touched))
    assert (matrix.users, matrix.items, matrix.cell_count) == (2, 3, 3)
    assert sparsity(matrix).first()["Sparsity_Pct"] == pytest.approx(500 / 6)
    assert {r[0]: r[1] for r in popularity(matrix).collect()} == {0: 0.0, 1: 5.0, 2: 0.0}
    assert {r[0]: r[1] for r in user_means(matrix).collect()} == {0: 10.0, 1: 0.0}
    assert [tuple(r) for r in wide(matrix).collect()] == [(0, 0.0, 10.0, 0.0), (1, 0.0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        wide(matrix, bound=2)


def test_wide_lists_and_metrics(spark):
    dense, touched = random_matrix(8)
    matrix = build_matrix(events_of(spark, dense, touched))
    lists = plans.item_item(matrix)
    titles = spark.createDataFrame([(0, "Zero"), (0 + 1, "One")], "Content_Key BIGINT, Titulo STRING")
    frame = recommend.wide_lists(lists, titles)
    assert frame.columns[:5] == [
        "Customer_Key", "Num_Recomendaciones", "Recomendacion_1_ContentKey", "Recomendacion_1_Titulo", "Recomendacion_1_Score"
    ]
    assert len(frame.columns) == 32
    got = lists_of(lists)
    for row in frame.collect():
        item, score = got[row["Customer_Key"]][0]
        assert row["Recomendacion_1_ContentKey"] == item
        assert row["Recomendacion_1_Titulo"] == {0: "Zero", 1: "One"}.get(item, f"Content {item}")
        assert row["Recomendacion_1_Score"] == pytest.approx(score, abs=5.1e-5)
    measured = metrics.list_metrics(lists, matrix).first()
    entries = [(u, i, s) for u, e in got.items() for i, s in e]
    assert measured["Recomendaciones_Totales"] == len(entries)
    assert measured["Diversidad"] == pytest.approx(len({i for _, i, _ in entries}) / dense.shape[1])
    unseen = sum(dense[u, i] == 0 for u, i, _ in entries)
    assert measured["Novedad"] == pytest.approx(unseen / len(entries))
    assert measured["Score_Medio"] == pytest.approx(np.mean([s for *_, s in entries]), abs=1e-6)


def test_tfidf_against_plain_python(spark):
    texts = {1: "red bolt red nut", 2: "blue bolt", 3: "the of", 4: "nut nut nut green"}
    df = spark.createDataFrame(list(texts.items()), "k BIGINT, t STRING")
    counts = tfidf.term_counts(df, "k", "t")
    terms = tfidf.vocabulary(counts, 6)
    got = {(r["row"], r["term"]): r["value"] for r in tfidf.weights(counts, terms, len(texts)).collect()}
    bags = {}
    for key, text in texts.items():
        words = [w for w in text.split() if w not in ("the", "of")]
        bags[key] = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    total = {}
    for bag in bags.values():
        for term in bag:
            total[term] = total.get(term, 0) + 1
    kept = sorted(total, key=lambda t: (-total[t], t))[:6]
    expected = {}
    for key, bag in bags.items():
        raw = {
            t: bag.count(t) * (math.log((1 + len(texts)) / (1 + sum(t in b for b in bags.values()))) + 1)
            for t in set(bag) & set(kept)
        }
        norm = math.sqrt(sum(v * v for v in raw.values()))
        expected.update({(key, t): v / norm for t, v in raw.items()})
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_text_recommender_against_brute_force(spark):
    dense, touched = random_matrix(9, items=12, density=0.25)
    matrix = build_matrix(events_of(spark, dense, touched))
    words = ["red", "blue", "bolt", "nut", "ring", "gear"]
    rng = np.random.default_rng(9)
    texts = [(i, " ".join(rng.choice(words, 4))) for i in range(12)]
    df = spark.createDataFrame(texts, "Content_Key BIGINT, Texto STRING")
    counts = tfidf.term_counts(df, "Content_Key", "Texto")
    vectors = np.zeros((12, 200))
    for r in tfidf.weights(counts, tfidf.vocabulary(counts), 12).collect():
        vectors[r["row"], r["feature"]] = r["value"]
    pairs = plans.text_similarity(matrix, df)
    got = recommend.top_lists(recommend.score_by_items(matrix, pairs), matrix)
    assert_same_lists(lists_of(got), by_items(dense, cosine(vectors)))


def test_histogram_of_equal_values_uses_one_bin(spark):
    dense = np.array([[1.0, 2.0], [1.0, 2.0], [1.0, 2.0]])
    matrix = build_matrix(events_of(spark, dense))
    bins = pairwise.pair_histogram(similarity.raw_user_units(matrix), 3, 6, 35).collect()
    assert len(bins) == 35 and [(b["Bin"], b["Pairs"]) for b in bins if b["Pairs"]] == [(17, 3)]
    assert sum(b["Pairs"] for b in bins) == 3


def test_top_recommended_breaks_ties_by_key(spark):
    lists = spark.createDataFrame(
        [(1, 1, 7, 1.0, 0.0), (2, 1, 5, 1.0, 0.0), (3, 1, 9, 1.0, 0.0), (4, 1, 9, 1.0, 0.0)],
        "Customer_Key BIGINT, Rank INT, Content_Key BIGINT, Score DOUBLE, Own_Minutes DOUBLE",
    )
    titles = spark.createDataFrame([(9, "x" * 50)], "Content_Key BIGINT, Titulo STRING")
    got = metrics.top_recommended(lists, titles, n=2).collect()
    assert [tuple(r) for r in got] == [(9, "x" * 34, 2), (5, "Content 5", 1)]
    assert lists.agg(F.count("*")).first()[0] == 4


def test_cells_too_many_to_broadcast_give_the_same_scores(spark, monkeypatch):
    dense, touched = random_matrix(31, users=24, items=14, density=0.4)
    matrix = build_matrix(events_of(spark, dense, touched))
    monkeypatch.setattr(recommend, "BROADCAST_ROWS", 0)
    scored = recommend.score_by_users(matrix, recommend.positive_users(matrix))
    # votes are counted where their rows came together: no shuffle of a row per vote
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct" in plan and "_cells" in plan
    assert_same_lists(lists_of(recommend.top_lists(scored, matrix)), by_users(dense))


@pytest.mark.parametrize("sent", [2_000_000, 40])
def test_one_tile_sends_sums_and_no_lists(spark, monkeypatch, sent):
    dense, touched = random_matrix(33, users=25, items=24, density=0.5)
    matrix = build_matrix(events_of(spark, dense, touched))
    monkeypatch.setattr(recommend, "SENT_PER_BLOCK", sent)
    pairs = similarity.item_pairs(matrix)
    scored = recommend.score_by_items(matrix, pairs)
    assert "flatten" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert_same_lists(lists_of(recommend.top_lists(scored, matrix)), by_items(dense, cosine(centre(dense).T)))

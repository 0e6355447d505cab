"""Nearest rows out of packed blocks: ties, keys that are missing, and what the plan copies."""

import numpy as np
import pytest

from cinelake.operators import pairwise


def units_of(full):
    full = full / np.maximum(np.sqrt((full * full).sum(axis=1)), 1e-300)[:, None]
    return full, [(int(r), int(c), float(full[r, c])) for r, c in zip(*np.nonzero(full))]


def expected(full, k):
    sims = np.round(np.clip(full @ full.T, -1, 1), 9)
    np.fill_diagonal(sims, 0)
    near = {r: sorted(range(len(full)), key=lambda c: (-sims[r, c], c))[:k] for r in range(len(full))}
    return {(r, c): sims[r, c] for r, cs in near.items() for c in cs if sims[r, c] > 0}


@pytest.mark.parametrize("rows_per_block", [65_536, 11])
def test_nearest_rows_of_packed_blocks(spark, monkeypatch, rows_per_block):
    """Half of the rows come three times, so that lists end within ties; negative values give no neighbours."""
    rng = np.random.default_rng(4)
    full = rng.normal(size=(40, 12)) * (rng.random((40, 12)) < 0.4)
    full, cells = units_of(np.vstack([full, full[:20], full[:20]]))
    monkeypatch.setattr(pairwise, "ROWS_PER_BLOCK", rows_per_block)
    units = spark.createDataFrame(cells, "row BIGINT, feature BIGINT, value DOUBLE")
    best = pairwise.top_positive(units, len(full), len(cells), 2)
    assert {(r.row, r.other): r.similarity for r in best.collect()} == pytest.approx(expected(full, 2), abs=2e-9)


def test_blocks_travel_packed_and_once_per_stretch(spark):
    _, cells = units_of(np.random.default_rng(4).random((30, 5)))
    best = pairwise.top_positive(spark.createDataFrame(cells, "row BIGINT, feature BIGINT, value DOUBLE"), 30, 150, 3)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "inline" in plan and "FlatMapGroupsInPandas" not in plan and "CartesianProduct" not in plan
    packed = spark.range(12).selectExpr("CAST(id AS INT) AS block")
    dealt = pairwise.stretch_pairs(packed, 4, 12)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 12 * 4
    ends = dealt.rdd.map(lambda r: (r.lo, r.hi)).mapPartitions(lambda rows: [len(set(rows))]).collect()
    assert ends == [1] * 10
    assert pairwise.dealt(50, pairwise.BLOCKS_PER_STRETCH, 6) == (13, 52)  # 13 copies of a block, not 50


def test_a_list_takes_lower_keys_of_equal_cosine_later(monkeypatch):
    """Tiles meet in the order of their bounds, so a lower key may come after the list is full."""
    monkeypatch.setattr(pairwise, "ROWS_PER_TILE", 4)
    full, cells = units_of(np.ones((19, 3)))
    row, feature, value = (np.array(x) for x in zip(*cells))
    blocks = [pairwise._Block.of(row[row % 2 == n], feature[row % 2 == n], value[row % 2 == n]) for n in (1, 0)]
    best = [pairwise._Best(block.keys, 3) for block in blocks]
    for i, j in ((0, 0), (0, 1), (1, 1)):
        pairwise.best_of_pair(blocks[i], blocks[j], best[i], best[j])
    got = {(r, c): s for b in best for r, c, s in b.frame().itertuples(index=False)}
    assert got == pytest.approx(expected(full, 3))

"""Parts of k-means: one round for several runs, seeds, and the whole fit against a plain version."""

import numpy as np
from pyspark.sql import functions as F

from faultline.operators import clustering


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "row bigint, x array<double>").repartition(3)


def slow_step(x, centres):
    squares = ((x[:, None, :] - centres) ** 2).sum(2)
    own = squares.argmin(1)
    return np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))]), squares.min(1).sum()


def test_step_of_several_runs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    runs = [rng.normal(size=(k, 3)) for k in (1, 2, 5)] + [np.array([[0.0, 0, 0], [99.0, 99, 99]])]  # no row is near the last centre
    for run, (centres, cost) in zip(runs, clustering.step(table(spark, x), runs)):
        want, want_cost = slow_step(x, run)
        np.testing.assert_allclose(centres, want, atol=1e-9)
        np.testing.assert_allclose(cost, want_cost)


def test_seeds_are_rows_far_apart(spark):
    x = np.concatenate([np.random.default_rng(2).normal(c, 0.01, (50, 2)) for c in (0, 10, 20)])
    for found in clustering.seeds(table(spark, x), [3] * 6 + [1], 7)[:6]:
        assert {round(float(c[0]) / 10) for c in found} == {0, 1, 2}
        assert all((np.abs(x - c).sum(1) < 1e-12).any() for c in found)


def test_fit_is_a_fixed_point_and_no_start_is_cheaper(spark):
    x = np.random.default_rng(4).normal(size=(300, 2))
    frame = table(spark, x).withColumnRenamed("x", "sensors")
    centres = np.array(clustering.fit(frame, 4).clusterCenters())
    moved, cost = slow_step(x, centres)
    assert np.abs(moved - centres).max() < 1e-3
    rows = clustering._numbered(frame, "sensors")
    assert cost <= min(run.cost for run in clustering._fitted(rows, [4] * clustering.STARTS, clustering.SEED, 300)) * (1 + 1e-9)


def test_fewer_rows_than_clusters(spark):
    frame = table(spark, np.ones((2, 2))).withColumnRenamed("x", "sensors")
    assert np.allclose(clustering.fit(frame, 3).clusterCenters(), 1.0)


def test_blocks_hold_all_rows(spark, monkeypatch):
    """Rounds read blocks of rows as bytes: the same draws, moves, costs and variance as from the rows themselves, in far fewer stored rows."""
    monkeypatch.setattr(clustering, "BLOCK_VALUES", 50)
    x = np.random.default_rng(3).normal(5, 2, (700, 3))
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "i long, x array<double>").repartition(3, "i")
    blocks = clustering._numbered(frame, "x")
    assert 700 / 16 <= blocks.count() <= 700 / 16 + 4
    plain = frame.select(F.monotonically_increasing_id().alias("row"), "x")
    assert np.isclose(clustering.mean_variance(blocks, x[0]), x.var(axis=0).mean())
    starts = clustering.seeds(blocks, [2, 4, 2], 7)
    assert sorted(map(len, starts)) == [2, 2, 4] and all((np.abs(x - c).sum(1) < 1e-12).any() for s in starts for c in s)
    for (a, cost_a), (b, cost_b), start in zip(clustering.step(blocks, starts), clustering.step(plain, starts), starts):
        want, want_cost = slow_step(x, start)
        assert np.allclose(a, want) and np.allclose(b, want) and np.allclose([cost_a, cost_b], want_cost)

"""Nearest-neighbour fill against brute force, for many layouts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import neighbors


def brute_fill(keys, x, k=5):
    width = x.shape[1]
    out = x.copy()
    for i in range(len(x)):
        for f in np.flatnonzero(np.isnan(x[i])):
            ranked = []
            for j in range(len(x)):
                both = ~np.isnan(x[i]) & ~np.isnan(x[j])
                if np.isnan(x[j, f]) or not both.any():
                    continue
                ranked.append((((x[i, both] - x[j, both]) ** 2).sum() * width / both.sum(), keys[j], x[j, f]))
            ranked.sort()
            out[i, f] = np.mean([r[2] for r in ranked[:k]]) if ranked else np.nanmean(x[:, f])
    return out


def frame_of(spark, keys, x, parts=4):
    rows = [(k, [None if np.isnan(v) else float(v) for v in row]) for k, row in zip(keys, x)]
    kind = "string" if isinstance(keys[0], str) else "bigint"
    return spark.createDataFrame(rows, f"row_key {kind}, sensors array<double>").repartition(parts).persist()


def filled(frame, **options):
    rows = neighbors.knn_impute(frame, **options).collect()
    return {r["row_key"]: np.array(r["sensors"], dtype=float) for r in rows}


@pytest.mark.parametrize("layout", [{}, {"block_rows": 16}, {"block_rows": 7, "max_cells": 3}])
def test_sprinkled_gaps(spark, layout):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 20, (4, 6))
    x = centres[rng.integers(0, 4, 150)] + rng.normal(0, 1, (150, 6))
    x[rng.random(x.shape) < 0.12] = np.nan
    x[5] = np.nan                      # a row with nothing to compare
    keys = list(range(150))
    want = brute_fill(keys, x)
    got = filled(frame_of(spark, keys, x), **layout)
    assert len(got) == 150
    for i in keys:
        np.testing.assert_allclose(got[i], want[i], rtol=1e-9, atol=1e-9)


def test_hot_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (120, 4)).astype(float)
    x[:50] = [1.0, 1.0, 1.0, 1.0]      # many copies of one row
    x[rng.random(x.shape) < 0.1] = np.nan
    keys = [f"w-{i}" for i in range(120)]   # text order, not number order
    want = brute_fill(keys, x)
    for layout in ({"block_rows": 20}, {"block_rows": 500}):
        got = filled(frame_of(spark, keys, x, 3), **layout)
        for i, key in enumerate(keys):
            np.testing.assert_allclose(got[key], want[i], atol=1e-9)


def test_pruning_skips_far_cells(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.5, (60, 5)) for c in (0.0, 100.0, 200.0)])
    means = x.mean(0)
    layout = neighbors.Layout(np.array([x[0], x[60], x[120]]), means)
    cell, distance = layout.assign(x)
    import pandas as pd
    cells = {c: (int((cell == c).sum()), float(distance[cell == c].max()), 0) for c in range(3)}
    ranges = pd.DataFrame([(c, p, int((cell == c).sum()), x[cell == c][:, p].min(), x[cell == c][:, p].max()) for c in range(3) for p in range(5)],
                          columns=["cell", "position", "n", "low", "high"])
    layout.summarise(cells, ranges)
    q = x[70].copy()
    q[2] = np.nan
    cells, least = layout.visits(q, 5)
    assert list(cells) == [1] and least[0] == 0


def test_few_donors_and_no_common_sensor(spark):
    nan = np.nan
    x = np.array([[1, nan, nan], [nan, 2, nan], [3, 4, nan], [nan, nan, 5.0]])
    keys = [1, 2, 3, 4]
    want = brute_fill(keys, x)
    got = filled(frame_of(spark, keys, x))
    for i, key in enumerate(keys):
        np.testing.assert_allclose(got[key], want[i])


def test_large_offsets_keep_exact_order(spark):
    rng = np.random.default_rng(6)
    x = 1e6 + rng.normal(0, 1e-3, (90, 4))
    x[::4, 1] = np.nan
    keys = list(range(90))
    want = brute_fill(keys, x)
    got = filled(frame_of(spark, keys, x), block_rows=30)
    for i in keys:
        np.testing.assert_allclose(got[i], want[i], rtol=1e-12)


def test_vote(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (80, 3))
    y = (x[:, 0] > 0).astype(int)
    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(80)]
    frame = spark.createDataFrame(rows, "row_key bigint, sensors array<double>, label int").persist()
    got = {r["row_key"]: r["probability"] for r in neighbors.knn_vote(frame, frame, block_rows=32).collect()}
    for i in range(80):
        near = np.lexsort((np.arange(80), ((x - x[i]) ** 2).sum(1)))[:5]
        assert got[i] == pytest.approx(y[near].mean())
    assert neighbors.knn_vote(frame.where("row_key < 0"), frame).count() == 0


def test_present_cells_stay(spark):
    frame = frame_of(spark, [1, 2, 3], np.array([[1.0, np.nan], [2.0, 5.0], [3.0, 6.0]]))
    joined = frame.alias("a").join(neighbors.knn_impute(frame).alias("b"), "row_key")
    changed = joined.where(F.exists(F.arrays_zip(F.col("a.sensors").alias("x"), F.col("b.sensors").alias("y")), lambda p: p.x.isNotNull() & (p.x != p.y)))
    assert joined.count() == 3 and changed.count() == 0


@pytest.mark.parametrize("within", [False, True])
@pytest.mark.parametrize("kind", ["patterns", "sprinkled", "rare", "offset", "equal"])
def test_tiles_against_all_pairs(monkeypatch, kind, within):
    """Bounds from products in single precision leave out no neighbour, and a search keeps few rows however many donors a task holds."""
    monkeypatch.setattr(neighbors, "TILE", (16, 64))
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2, (400, 6)).astype(float) if kind == "equal" else rng.normal(0, 1, (400, 6))
    x = x * 1e-3 + 1e6 if kind == "offset" else x
    if kind == "patterns":
        x[(np.arange(400)[:, None] + np.arange(6)) % 3 == 0] = np.nan
    else:
        x[rng.random(x.shape) < 0.2] = np.nan
    if kind == "rare":
        x[7:, 2] = np.nan
    keys, queries = rng.permutation(400), x[:60]
    want, reach = {}, np.full(60, np.inf)
    for i, q in enumerate(queries):
        common = (~np.isnan(x) & ~np.isnan(q)).sum(1)
        distance = np.where(common > 0, np.nansum((x - q) ** 2, axis=1) * 6 / np.maximum(common, 1), np.inf)
        for t in np.flatnonzero(np.isnan(q)):
            can = np.flatnonzero(~np.isnan(x[:, t]) & (common > 0))
            want[i, t] = can[np.lexsort((keys[can], distance[can]))][:5].tolist()
        full = [want[i, t] for t in np.flatnonzero(np.isnan(q))]
        if full and all(len(f) == 5 for f in full):
            reach[i] = max(distance[f[-1]] for f in full)
    got = {}
    for i, t, d, _ in sorted(zip(*neighbors._local_top(queries, x, keys, 5, reach if within else None)), key=lambda r: (r[0], r[1], r[3], keys[r[2]])):
        got.setdefault((int(i), int(t)), []).append(int(d))
    assert got == {at: found for at, found in want.items() if found}


def test_a_part_holds_many_blocks(spark, monkeypatch):
    """The rows that tasks hand on for a query grow with the parts, 65,536 donors each, and not with every 2,048 donors."""
    x = np.random.default_rng(2).normal(0, 1, (9000, 4))
    x[:40, 1] = np.nan
    counted = []
    monkeypatch.setattr(neighbors, "stored", lambda frame, keep=neighbors.stored: counted.append(frame.columns) or keep(frame))
    got = filled(frame_of(spark, list(range(9000)), x).where("row_key < 9000"))
    assert ["key", "position", "donor", "distance", "donated"] not in counted     # one part: no second search
    near = np.argsort(np.nansum((x - x[3]) ** 2, axis=1) + np.where(np.isnan(x[:, 1]), np.inf, 0), kind="stable")[:5]
    assert got[3][1] == pytest.approx(x[near, 1].mean())

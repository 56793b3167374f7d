"""Whitening against a dense solver, and the parts of the contour method."""

import math

import numpy as np
import pytest

from faultline.llm import whitening
from faultline.llm.queries import QUERIES


def slow(rows):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in vector]))
    width = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + [0] * (width - len(x))) for i, x in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=float).reshape(-1, width)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    if not n or not width:
        return {}
    centred = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for vec_id, x in kept:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(min(4, int((values > 1e-12 * values.sum()).sum()))):
            score = (np.array(x) - np.array(sums) / n) @ vectors[:, -1 - c] / np.sqrt(values[-1 - c])
            out.setdefault((vec_id, c + 1), []).append((n, deviation, abs(score), values[-1 - c] / values.sum()))
    return out


def check(frame, rows):
    want, got = slow(rows), {}
    for r in frame.collect():
        assert r.identity_error <= 1e-9
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
    assert got.keys() == want.keys()
    for key in want:
        for a, b in zip(sorted(got[key]), sorted(want[key])):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-7)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, f"/root/testdata/{sf}"), rows)


SCHEMA = "vec_id bigint, embedding array<float>"


def test_edge_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(40)] + [(5, [0.5] * 6)] * 30
    rows += [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (52, [float("nan")] * 6), (53, [float("-inf")] + [0.0] * 5), (None, [0.25] * 6), (54, [0.1]), (55, []), (56, [-0.0] * 6)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' as x", "1 as n", "2 as component").repartition(5)
    check(whitening.whitened(frame), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.5])] * 3])
def test_no_component(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_fewer_components_than_four(spark):
    rows = [(i, [i / 7, 2 * i / 7, 1.0]) for i in range(0, 70, 7)]
    check(whitening.whitened(spark.createDataFrame(rows, SCHEMA)), rows)


def test_deviation_is_exact_and_null_beyond_64_bits():
    x = np.array([[3, -4], [1 << 40, 0]], dtype=np.int64)
    assert whitening.deviations(x, 2, [1, 1]) == [25 + 81, None]
    assert whitening.deviations(x[:1], 1 << 28, [5, 5]) == [((1 << 28) * 3 - 5) ** 2 + ((1 << 28) * 4 + 5) ** 2]


def symmetric(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [np.arange(1.0, 31), [1e9, 5, 4, 3, 2, 1], [7, 7, 7, 7, 7, 1, 0, 0], [1, 0, 0, 0], np.geomspace(1e-8, 1e4, 40), [3, 2, 1]])
def test_feast_finds_the_largest(values):
    values = np.sort(np.array(values, dtype=float))[::-1]
    matrix = symmetric(values, 3)
    wanted = min(4, len(values), int((values > 0).sum()))
    found, vectors = whitening.feast(matrix, wanted)
    assert found == pytest.approx(values[:wanted], rel=1e-9, abs=1e-15 * values[0])
    assert np.abs(vectors @ vectors.T - np.eye(wanted)).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * values[0]


def test_inertia_counts():
    values = np.array([-3.0, -1, 0.5, 2, 2, 9])
    matrix = symmetric(values, 5)
    for shift in (-4, -2, 0, 1, 3, 10):
        assert whitening.below(matrix, shift) == (values < shift).sum()
    assert whitening.below(np.array([[0.0, 1], [1, 0]]), 0) == 1

"""AUC, accuracy, choice, scaling, cluster costs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import clustering, metrics, reporting, scaling


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("digits", [1, 12])
def test_auc(spark, digits):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 900)
    s = np.round(rng.random(900) + 0.2 * y, digits)
    frame = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double").repartition(5)
    for n_rows in (None, 900):
        assert metrics.roc_auc(frame, n_rows=n_rows).first()["auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_bucket_counts_edges(spark):
    edges = [i / 256 for i in range(1, 256)]
    points = [0.0, 1 / 256, 0.05, 0.0625, 0.5, 254.5 / 256, 255 / 256, 1.0]
    frame = spark.createDataFrame([(p,) for p in points], "s double")
    for used in (edges, edges[:40], edges[:5], []):
        got = [r[0] for r in frame.select(metrics._bucket(F.col("s"), used)).collect()]
        assert got == [sum(e <= p for e in used) for p in points]


def test_one_class_uses_accuracy(spark):
    frame = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2)], "label int, prediction int, probability double")
    assert metrics.evaluate(frame) == ("accuracy", 0.5)


def test_choice():
    assert metrics.best_of([("a", 0.7), ("b", 0.9), ("c", 0.9)]) == "b"
    assert metrics.best_of([("a", 0.0)]) is None
    assert metrics.best_of([]) is None


def test_scaling(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(5, 3, (50, 3))
    x[:, 2] = 4.0
    frame = spark.createDataFrame([([float(v) for v in r],) for r in x], "sensors array<double>")
    scaled = np.array([r[0] for r in frame.select(scaling.scale(F.col("sensors"), *scaling.fit_scaler(frame))).collect()])
    np.testing.assert_allclose(scaled[:, :2].mean(0), 0, atol=1e-9)
    np.testing.assert_allclose(scaled[:, :2].var(0), 1, atol=1e-9)
    np.testing.assert_allclose(scaled[:, 2], 0)


def test_clusters(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in (0, 10, 20)])
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_key int, sensors array<double>").coalesce(1).persist()
    sweep = clustering.wcss_sweep(frame, 4)
    costs = [c for _, c in sweep]
    assert costs[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert costs[2] < 0.05 * costs[0] and costs == sorted(costs, reverse=True)
    first = clustering.assign(clustering.fit(frame), frame)
    ids = {r["row_key"]: r["cluster"] for r in first.collect()}
    assert {len({ids[i] for i in range(a, a + 40)}) for a in (0, 40, 80)} == {1}
    again = {r["row_key"]: r["cluster"] for r in clustering.assign(clustering.fit(frame), frame).collect()}
    assert ids == again
    assert clustering.distinct_clusters(first) == [0, 1, 2]


def test_reporting(spark):
    scored = spark.createDataFrame([("Wafer-9", 0, 1, 0.8), ("Wafer-10", 1, 0, 0.3)], "wafer_id string, cluster int, prediction int, probability double")
    rows = reporting.prediction_rows(scored.where("cluster = 0"), F.lit("m")).unionByName(reporting.default_rows(scored.where("cluster = 1")))
    assert tuple(rows.columns) == reporting.PREDICTION_COLUMNS
    first, second = reporting.sorted_by_wafer(rows).collect()
    assert (first["wafer_id"], first["model_used"], first["prediction_label"], first["confidence"], first["prob_good"]) == ("Wafer-10", "default", "Bad", 0.5, None)
    assert (second["prediction_label"], second["confidence"]) == ("Good", 0.8)
    summary = reporting.batch_summary(rows).first()
    assert (summary["total"], summary["good"], summary["good_pct"], summary["mean_confidence_pct"]) == (2, 1, 50.0, 65.0)

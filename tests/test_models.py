"""Candidates, the fitted chain, and scoring."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import clustering, metrics, models, reporting
from faultline.plans import predict as scoring
from faultline.plans.train import Chain, train, train_rows
from faultline.session import durable


@pytest.fixture(scope="module", autouse=True)
def short_fits():
    """Fewer rounds than in use; the fits are the same otherwise."""
    patch = pytest.MonkeyPatch()
    for name, value in {"XGB_ROUNDS": 3, "GBM_ROUNDS": 3, "ADA_ROUNDS": 8, "FOREST_TREES": 10}.items():
        patch.setattr(models, name, value)
    patch.setattr(clustering, "STARTS", 2)
    yield
    patch.undo()


def blobs(n=120, width=4, seed=0, gaps=0.0):
    rng = np.random.default_rng(seed)
    x = np.array([[0.0] * width, [12.0] * width, [24.0] * width])[np.arange(n) % 3] + rng.normal(0, 1, (n, width))
    y = (x[:, 0] - 12 * (np.arange(n) % 3) > 0).astype(int)
    x[rng.random(x.shape) < gaps] = np.nan
    return x, y


def rows_of(spark, x, y):
    data = [(i, [None if np.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "row_key bigint, sensors array<double>, label int").coalesce(2)


@pytest.mark.parametrize("name", list(models.CANDIDATES))
def test_candidate_learns_and_round_trips(spark, tmp_path, name):
    x, y = blobs()
    x = x - 12 * (np.arange(len(x)) % 3)[:, None]
    frame = rows_of(spark, x, y).persist()
    fitted = models.CANDIDATES[name](frame)
    scored = fitted.score(frame)
    assert set(scored.columns) >= {"row_key", "sensors", "label", "probability", "prediction"}
    kind, score = metrics.evaluate(scored)
    assert kind == "auc" and score > 0.9
    fitted.save(str(tmp_path / "m"), spark)
    again = models.Fitted.load(str(tmp_path / "m"), spark).score(frame)
    want = {r["row_key"]: r["probability"] for r in scored.collect()}
    got = {r["row_key"]: r["probability"] for r in again.collect()}
    assert got == pytest.approx(want)


def test_boosted_stumps_follow_the_definition(spark):
    """Against a plain-numpy run on the same thresholds."""
    x, y = blobs(60, 2, seed=5)
    x = x - 12 * (np.arange(60) % 3)[:, None]
    y[::7] = 1 - y[::7]
    frame = rows_of(spark, x, y).persist()
    points = models._split_points(frame)
    weight, decision = np.ones(60), np.zeros(60)
    for _ in range(models.ADA_ROUNDS):
        best = None
        for f, thresholds in enumerate(points):
            for t in thresholds:
                left = x[:, f] <= t
                w, w1 = [weight[s].sum() for s in (left, ~left)], [(weight * y)[s].sum() for s in (left, ~left)]
                purity = sum((b**2 + (a - b) ** 2) / a for a, b in zip(w, w1))
                if best is None or purity > best[0] + 1e-12:
                    best = (purity, left, [b / a for a, b in zip(w, w1)])
        p = np.clip(np.where(best[1], *best[2]), models.EPS, None)
        q = np.clip(1 - np.where(best[1], *best[2]), models.EPS, None)
        half = 0.5 * (np.log(p) - np.log(q))
        decision += half
        weight *= np.exp(-(2 * y - 1) * half)
    want = 1 / (1 + np.exp(-2 * decision / models.ADA_ROUNDS))
    got = {r["row_key"]: r["probability"] for r in models._fit_ada(frame).score(frame).collect()}
    np.testing.assert_allclose([got[i] for i in range(60)], want, rtol=1e-9)


def test_failures_stay_with_their_candidate(spark, monkeypatch):
    def broken(frame):
        raise RuntimeError("no fit")

    monkeypatch.setitem(models.CANDIDATES, "SVM", broken)
    x, y = blobs()
    chain = train_rows(durable(rows_of(spark, x, y)), [f"sensor_{i}" for i in range(4)], candidates=["SVM", "DecisionTree"], imputer="mean")
    assert {name for name, _ in chain.models.values()} == {"DecisionTree"}
    failed = chain.registry(spark).where("model_name = 'SVM'").collect()
    assert len(failed) == 3 and all("no fit" in r["failure"] and not r["chosen"] for r in failed)


@pytest.fixture(scope="module")
def trained(spark):
    x, y = blobs(150, 4, seed=1, gaps=0.05)
    names = ["Wafer", "sensor_1", "sensor_2", "sensor_3", "sensor_4", "flat", "gone", "Output"]
    data = [
        (f"w{i:03d}", *[None if np.isnan(v) else float(v) for v in x[i]], 7.0, None, None if i == 3 else (1 if y[i] else -1))
        for i in range(150)
    ]
    kinds = ", ".join(f"{n} {'string' if n == 'Wafer' else 'int' if n == 'Output' else 'double'}" for n in names)
    wide = spark.createDataFrame(data, kinds).coalesce(2).persist()
    chain = train(wide, candidates=["DecisionTree", "LogisticRegression", "KNN"], elbow=True)
    return wide, chain


def test_chain_contents(spark, trained):
    _, chain = trained
    assert chain.features == ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]
    assert chain.dropped_unlabelled == 1
    assert [k for k, _ in chain.wcss] == list(range(1, 11)) and chain.wcss[2][1] < chain.wcss[0][1] / 5
    assert sorted(chain.models) == [0, 1, 2]
    registry = chain.registry(spark)
    assert registry.count() == 9 and registry.where("chosen").count() == 3


def as_map(frame):
    return {r["wafer_id"]: (r["cluster"], r["prediction"], round(r["confidence"], 9), r["model_used"]) for r in frame.collect()}


def test_predictions_survive_saving(spark, trained, tmp_path):
    wide, chain = trained
    want = scoring.predict(wide.drop("Output"), chain)
    assert tuple(want.columns) == reporting.PREDICTION_COLUMNS
    chain.save(str(tmp_path / "chain"), spark)
    loaded = Chain.load(str(tmp_path / "chain"), spark)
    assert loaded.features == chain.features and loaded.scores == chain.registry(spark).rdd.map(lambda r: r.asDict()).collect()
    expected = as_map(want)
    assert len(expected) == 150
    assert as_map(scoring.predict(wide.drop("Output"), loaded)) == expected
    one = wide.where("Wafer = 'w017'")
    assert as_map(scoring.predict(one, loaded)) == {"w017": expected["w017"]}


def test_missing_model_gives_default_rows(spark, trained):
    wide, chain = trained
    partial = Chain(chain.features, chain.means, chain.kmeans, chain.scalers, {c: m for c, m in chain.models.items() if c != 1})
    rows = scoring.predict(wide, partial)
    defaults = rows.where("model_used = 'default'")
    assert defaults.select("cluster").distinct().collect() == [(1,)]
    assert defaults.where("prediction = 0 and prediction_label = 'Bad' and confidence = 0.5 and prob_good is null").count() == defaults.count() > 0
    assert rows.count() == 150


def test_tables_without_ids_or_sensors(spark, trained):
    wide, chain = trained
    rows = scoring.predict(wide.drop("Wafer", "sensor_4"), chain)
    assert sorted(int(r["wafer_id"]) for r in rows.collect()) == list(range(150))


def test_refit_and_batch_fill(spark, trained):
    wide, chain = trained
    assert scoring.predict(wide, chain, cluster_mode="refit").count() == 150
    names = ["Sensor - 1", "Sensor - 2", "Sensor - 3", "Sensor - 4", "Note"]
    cells = F.array(*[F.col(f"sensor_{i}").cast("string") for i in range(1, 5)], F.lit("text"))
    frame = wide.select(F.col("Wafer").alias("wafer_id"), cells.alias("cells"))
    rows, texts = scoring.predict_batch_filled(frame, names, chain)
    assert texts == ["Note"] and rows.count() == 150


def test_csv_output(spark, trained, tmp_path):
    wide, chain = trained
    path = scoring.predict_to_csv(wide, chain, "/in/batch.csv", str(tmp_path))
    stored = spark.read.option("header", True).csv(path)
    assert path.startswith(f"{tmp_path}/predictions_batch_") and stored.count() == 150


def test_one_class_cluster(spark):
    x, y = blobs(90)
    y[np.arange(90) % 3 == 0] = 0
    y[np.arange(90) % 3 == 1] = 1
    rows = durable(rows_of(spark, x, y))
    chain = train_rows(rows, [f"sensor_{i}" for i in range(4)], imputer="mean", candidates=["LogisticRegression", "KNN"], evaluation="train")
    kinds = {(r["metric"], r["score"]) for r in chain.registry(spark).where("metric = 'accuracy'").collect()}
    assert kinds == {("accuracy", 1.0)}
    scored = scoring.predict_rows(rows.select(F.col("row_key").cast("string").alias("wafer_id"), "sensors"), chain)
    sure = {int(r["wafer_id"]): r["prob_good"] for r in scored.collect() if int(r["wafer_id"]) % 3 < 2}
    assert all(p == pytest.approx(i % 3, abs=0.05) for i, p in sure.items())


def test_holdout_only_chooses(spark):
    """The model in use has learned from every row, and readings that are not finite are gaps."""
    x, y = blobs(150)
    wide = spark.createDataFrame([(f"w{i}", *[float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))], "wafer string, a double, b double, c double, d double, output int")
    wide = wide.withColumn("a", F.when(F.col("wafer") == "w7", float("inf")).otherwise(F.col("a")))
    chain = train(wide, imputer="mean", candidates=["DecisionTree"])
    assert {s["evaluated_on"] for s in chain.scores} == {"holdout"}
    scored = scoring.predict(wide, chain)
    right = scored.join(wide, scored["wafer_id"] == wide["wafer"]).where(F.col("prediction") == F.col("output")).count()
    assert right >= 145


def test_a_cluster_without_a_second_side(spark):
    rows = spark.createDataFrame([(i, [float(i > 3) * 50 + i * (i < 3)], i % 2) for i in range(5)], "row_key bigint, sensors array<double>, label int")
    chain = train_rows(rows, ["a"], clusters=2, imputer="mean", candidates=["DecisionTree"])
    assert {s["cluster"]: s["evaluated_on"] for s in chain.scores}.keys() == {0, 1}
    assert sorted(s["evaluated_on"] for s in chain.scores) == ["holdout", "train"]


def test_summary_of_an_empty_batch(spark):
    empty = reporting.batch_summary(spark.createDataFrame([], "prediction int, confidence double")).first()
    assert (empty["total"], empty["good_pct"], empty["bad_pct"]) == (0, None, None)


def test_csv_in_and_out(spark, tmp_path):
    x, y = blobs(90)
    names = ["Sensor - 1", "Sensor - 2", "Sensor - 3", "Sensor - 4"]
    wide = spark.createDataFrame([(f"w{i:02}", *[float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))], "wafer string, sensor_1 double, sensor_2 double, sensor_3 double, sensor_4 double, output int")
    chain = train(wide, imputer="mean", candidates=["DecisionTree"])
    lines = [",".join(["Wafer", *names])] + [",".join([f"w{i:02}", *(str(v) for v in r)]) for i, r in enumerate(x)]
    lines[3] = "w02,NA,?,," + str(x[2][3])
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    want = {r["wafer_id"]: r["prediction"] for r in scoring.predict(wide.where("wafer != 'w02'"), chain).collect()}
    for batch_filled in (False, True):
        path = scoring.predict_csv(spark, str(tmp_path / "in.csv"), chain, str(tmp_path / f"out{batch_filled}"), batch_filled=batch_filled)
        got = spark.read.option("header", True).csv(path).collect()
        assert [r["wafer_id"] for r in got] == [f"w{i:02}" for i in range(90)]
        assert all(int(r["prediction"]) == want[r["wafer_id"]] for r in got if r["wafer_id"] in want)

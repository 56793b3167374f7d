"""The eight candidate classifiers, behind one fit / score / save interface.

Training frames are ``(row_key, sensors, label)`` with scaled sensors and labels 0/1. ``score`` adds
``probability`` (of class 1) and ``prediction``.

``RandomForest`` is a stored table of trees (``forest.py``), ``XGBoost`` second-order boosting (``boosting.py``). ``SVM`` has no Spark counterpart and approximates the RBF kernel by random
Fourier features under a linear SVM, calibrated by logistic regression.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import classification as ml
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faultline.functions import literal_arrays as constants
from faultline.operators import boosting, forest
from faultline.operators.neighbors import knn_vote
from faultline.session import ship_package

SEED = 42
# Library defaults of the candidate models.
FOREST_TREES = 100
TREE_DEPTH = 30  # Spark's limit; the originals grow without one
XGB_ROUNDS = boosting.ROUNDS
GBM_ROUNDS, GBM_RATE, GBM_DEPTH = 100, 0.1, 3
LOGISTIC_ITERATIONS = 2000
ADA_ROUNDS = 50
SPLIT_BINS = 32
FOLD_ROUNDS = 10  # rounds of boosting whose stumps are evaluated anew in each round
NODE_MEMORY_MB = 1024  # memory of a pass over the nodes of deep trees; more means fewer passes
VOTERS = 5
FOURIER_FEATURES = 256

EPS = float(np.finfo(float).eps)


@dataclass
class Fitted:
    """A fitted candidate: plain parameters, Spark ML parts, and at most one stored table."""

    kind: str
    params: dict = field(default_factory=dict)
    parts: dict = field(default_factory=dict)
    table: DataFrame | None = None

    def score(self, df: DataFrame) -> DataFrame:
        return SCORERS[self.kind](self, df)

    def save(self, path: str, spark: SparkSession) -> None:
        for name, part in self.parts.items():
            part.write().overwrite().save(f"{path}/{name}")
        if self.table is not None:
            self.table.write.mode("overwrite").parquet(f"{path}/table")
        about = {"kind": self.kind, "params": self.params, "table": self.table is not None,
                 "parts": {n: type(p).__name__ for n, p in self.parts.items()}}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "Fitted":
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        parts = {n: getattr(ml, kind).load(f"{path}/{n}") for n, kind in about["parts"].items()}
        table = spark.read.parquet(f"{path}/table") if about["table"] else None
        return cls(about["kind"], about["params"], parts, table)


def _vector(df: DataFrame, array: str = "sensors") -> DataFrame:
    return df.withColumn("features", array_to_vector(array))


def _positive(probability: Column) -> Column:
    """Probability of class 1; a model that has seen only class 0 knows no second class."""
    return F.coalesce(F.get(vector_to_array(probability), F.lit(1)), F.lit(0.0))


# -- Spark ML classifiers -----------------------------------------------------------------------------------


def _fit_ml(estimator) -> Callable[[DataFrame], Fitted]:
    def fit(train: DataFrame) -> Fitted:
        model = estimator.fit(_vector(train).select("features", F.col("label").cast("double").alias("label")))
        return Fitted("ml", parts={"model": model})

    return fit


def _score_ml(fitted: Fitted, df: DataFrame) -> DataFrame:
    scored = fitted.parts["model"].transform(_vector(df))
    return scored.select(
        *df.columns, _positive(F.col("probability")).alias("probability"), F.col("prediction").cast("int").alias("prediction")
    )


def _fit_logistic(train: DataFrame) -> Fitted:
    # Spark averages the loss over rows, so a penalty constant of 1 on their sum is 1/n.
    estimator = ml.LogisticRegression(maxIter=LOGISTIC_ITERATIONS, regParam=1.0 / max(train.count(), 1), elasticNetParam=0.0, standardization=False)
    return _fit_ml(estimator)(train)


# -- support vector machine ---------------------------------------------------------------------------------


@cache
def _fourier(width: int, n_features: int, gamma: float, seed: int):
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * gamma), (width, n_features)), rng.uniform(0, 2 * np.pi, n_features)


def _with_fourier(df: DataFrame, width: int, n_features: int, gamma: float, seed: int) -> DataFrame:
    ship_package(df.sparkSession)

    @F.pandas_udf("array<double>")
    def lifted(sensors: pd.Series) -> pd.Series:
        weights, shift = _fourier(width, n_features, gamma, seed)
        x = np.stack(sensors.to_numpy()) if len(sensors) else np.empty((0, width))
        return pd.Series(list(np.sqrt(2.0 / n_features) * np.cos(x @ weights + shift)))

    return df.withColumn("lifted", lifted("sensors"))


def _fit_svm(train: DataFrame) -> Fitted:
    n, width = train.agg(F.count("*"), F.max(F.size("sensors"))).first()
    params = {"width": width, "n_features": FOURIER_FEATURES, "gamma": 1.0 / width, "seed": SEED}
    frame = _vector(_with_fourier(train, **params), "lifted").select("features", F.col("label").cast("double").alias("label")).persist()
    try:
        machine = ml.LinearSVC(maxIter=100, tol=1e-3, regParam=1.0 / n, standardization=False).fit(frame)
        margins = machine.transform(frame).select(
            array_to_vector(F.array(F.get(vector_to_array("rawPrediction"), F.lit(1)))).alias("features"), "label"
        )
        calibration = ml.LogisticRegression(maxIter=100).fit(margins)
    finally:
        frame.unpersist()
    return Fitted("svm", params, {"machine": machine, "calibration": calibration})


def _score_svm(fitted: Fitted, df: DataFrame) -> DataFrame:
    lifted = _vector(_with_fourier(df, **fitted.params), "lifted")
    margin = fitted.parts["machine"].transform(lifted)
    on_margin = margin.select(*df.columns, F.col("prediction").cast("int").alias("prediction"),
                              array_to_vector(F.array(F.get(vector_to_array("rawPrediction"), F.lit(1)))).alias("features"))
    calibration = fitted.parts["calibration"]
    slope, intercept = float(calibration.coefficients[0]), float(calibration.intercept)
    logit = F.get(vector_to_array("features"), F.lit(0)) * slope + intercept
    return on_margin.withColumn("probability", 1 / (1 + F.exp(-logit))).drop("features")


# -- nearest neighbours -------------------------------------------------------------------------------------


def _fit_knn(train: DataFrame) -> Fitted:
    return Fitted("knn", {"k": VOTERS}, table=train.select("row_key", "sensors", "label"))


def _score_knn(fitted: Fitted, df: DataFrame) -> DataFrame:
    voted = knn_vote(df, fitted.table, k=fitted.params["k"])
    return voted.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


# -- random forest ------------------------------------------------------------------------------------------


def _fit_forest(train: DataFrame) -> Fitted:
    params, table = forest.fit(train, FOREST_TREES, TREE_DEPTH, SEED)
    return Fitted("forest", params, table=table)


# -- boosted stumps -----------------------------------------------------------------------------------------


def _half_log_odds(sensors: Column, stumps: list[list[float]]) -> Column:
    """Sum over stumps of half the log-odds of class 1 in the row's leaf."""
    if not stumps:
        return F.lit(0.0)
    table = constants.double_rows(stumps)
    return F.aggregate(
        table, F.lit(0.0), lambda total, s: total + F.when(F.get(sensors, s[0].cast("int")) <= s[1], s[2]).otherwise(s[3])
    )


def _split_points(train: DataFrame) -> list[list[float]]:
    """Candidate thresholds per position: approximate quantiles, without the last one, which splits nothing off."""
    shares = [i / SPLIT_BINS for i in range(1, SPLIT_BINS)]
    rows = (
        train.select(F.posexplode("sensors").alias("position", "value"))
        .groupBy("position")
        .agg(F.percentile_approx("value", shares, 10_000).alias("points"), F.max("value").alias("top"))
        .orderBy("position")
        .collect()
    )
    return [sorted({p for p in r["points"] if p < r["top"]}) for r in rows]


def _best_stump(cells: pd.DataFrame, points: list[list[float]]) -> tuple[list[float], float]:
    """Stump of least Gini impurity from weight sums per (position, bin), and its weighted error."""
    weight, ones = np.zeros((len(points), SPLIT_BINS)), np.zeros((len(points), SPLIT_BINS))
    at = (cells["position"].to_numpy(), cells["bin"].to_numpy())
    weight[at], ones[at] = cells["w"].to_numpy(), cells["w1"].to_numpy()
    total, total_ones = weight[0].sum(), ones[0].sum()
    left, left_ones = weight.cumsum(1), ones.cumsum(1)
    right, right_ones = total - left, total_ones - left_ones
    valid = np.array([[b < len(p) for b in range(SPLIT_BINS)] for p in points]) & (left > 0) & (right > EPS * total)
    if not valid.any():
        odds = _half_logit(total_ones, total)
        return [0.0, float("inf"), odds, odds], min(total_ones, total - total_ones) / total
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left_ones**2 + (left - left_ones) ** 2) / left + (right_ones**2 + (right - right_ones) ** 2) / right
    position, b = np.unravel_index(np.where(valid, purity, -np.inf).argmax(), purity.shape)
    sides = [(left_ones[position, b], left[position, b]), (right_ones[position, b], right[position, b])]
    error = sum(max(min(w1, w - w1), 0.0) for w1, w in sides) / total
    return [float(position), points[position][b], *[_half_logit(*side) for side in sides]], error


def _half_logit(ones: float, weight: float) -> float:
    p = min(max(ones / weight, 0.0), 1.0)
    return 0.5 * float(np.log(max(p, EPS)) - np.log(max(1 - p, EPS)))


def _histograms(batches):
    """Weight sums, in all and of label 1, per position and bin of the rows of one task."""
    weight = ones = None
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = batch.column("bins").flatten().to_numpy().reshape(batch.num_rows, -1)
        w, y = batch.column("weight").to_numpy(), batch.column("label").to_numpy()
        width = bins.shape[1]
        at = (bins + np.arange(width) * SPLIT_BINS).ravel()
        if weight is None:
            weight, ones = np.zeros(width * SPLIT_BINS), np.zeros(width * SPLIT_BINS)
        weight += np.bincount(at, np.repeat(w, width), len(weight))
        ones += np.bincount(at, np.repeat(w * y, width), len(weight))
    if weight is not None:
        used = np.flatnonzero(weight)
        columns = [used // SPLIT_BINS, used % SPLIT_BINS, weight[used], ones[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["position", "bin", "w", "w1"])


def _fit_ada(train: DataFrame) -> Fitted:
    """Real AdaBoost on depth-one trees: one aggregation over binned sensors per round.

    A task sums its rows' weights per position and bin before anything is shuffled. Row weights follow from the stumps so far; every
    ``FOLD_ROUNDS`` rounds those are folded into a kept column, so a round evaluates few stumps per row.
    """
    ship_package(train.sparkSession)
    points = _split_points(train)
    edges = constants.double_rows(points)
    bins = F.transform("sensors", lambda x, i: F.size(F.filter(F.get(edges, i), lambda edge: edge < x)))
    frame = train.select("sensors", bins.alias("bins"), F.col("label").cast("double").alias("label"), F.lit(0.0).alias("done")).persist()
    sign = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    stumps: list[list[float]] = []
    folded = 0
    try:
        for _ in range(ADA_ROUNDS):
            if len(stumps) - folded == FOLD_ROUNDS:
                done = F.col("done") + _half_log_odds(F.col("sensors"), stumps[folded:])
                older, frame = frame, frame.withColumn("done", done).persist()
                frame.count()
                older.unpersist()
                folded = len(stumps)
            weight = F.exp(-sign * (F.col("done") + _half_log_odds(F.col("sensors"), stumps[folded:])))
            cells = (
                frame.select("label", weight.alias("weight"), "bins")
                .mapInArrow(_histograms, "position bigint, bin bigint, w double, w1 double")
                .groupBy("position", "bin")
                .agg(F.sum("w").alias("w"), F.sum("w1").alias("w1"))
            )
            stump, error = _best_stump(cells.toPandas(), points)
            stumps.append(stump)
            if error <= EPS or np.isinf(stump[1]):
                break
    finally:
        frame.unpersist()
    return Fitted("ada", {"stumps": stumps})


def _score_ada(fitted: Fitted, df: DataFrame) -> DataFrame:
    stumps = fitted.params["stumps"]
    decision = _half_log_odds(F.col("sensors"), stumps) / max(len(stumps), 1)
    return df.withColumn("probability", 1 / (1 + F.exp(-2 * decision))).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


SCORERS = {"ml": _score_ml, "svm": _score_svm, "knn": _score_knn, "ada": _score_ada,
           "newton": lambda fitted, df: boosting.score(df, fitted.params), "forest": lambda fitted, df: forest.score(df, fitted.params, fitted.table)}

# Candidates in declared order, which decides ties.
CANDIDATES: dict[str, Callable[[DataFrame], Fitted]] = {
    "RandomForest": _fit_forest,
    "XGBoost": lambda train: Fitted("newton", boosting.fit(train, XGB_ROUNDS)),
    "LogisticRegression": _fit_logistic,
    "DecisionTree": lambda train: _fit_ml(ml.DecisionTreeClassifier(maxDepth=TREE_DEPTH, seed=SEED, maxMemoryInMB=NODE_MEMORY_MB))(train),
    "SVM": _fit_svm,
    "KNN": _fit_knn,
    "GradientBoosting": lambda train: _fit_ml(ml.GBTClassifier(maxIter=GBM_ROUNDS, stepSize=GBM_RATE, maxDepth=GBM_DEPTH, seed=SEED))(train),
    "AdaBoost": _fit_ada,
}

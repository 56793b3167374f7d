"""k-means on the sensor array: cost sweep, fit, assignment."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faultline.functions import literal_arrays as constants
from faultline.session import ship_package, stored

# The cluster count in use, the sweep's end, the seed, starts and rounds, and the least move, as a share of the mean variance.
CLUSTERS = 3
MAX_CLUSTERS = 10
SEED = 42
STARTS = 10
ITERATIONS = 300
TOLERANCE = 1e-4
SETTLED = 1e-8  # for the cheapest run, which goes on until its centres stay
BLOCK_VALUES = 1 << 14  # readings in a stored block of rows
CHUNK_ROWS = 1 << 11  # rows that a task works on at a time


def with_features(df: DataFrame, array: str = "sensors", name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(array))


@dataclass
class Run:
    """One start: its centres so far (k x d) and, once measured, its cost."""

    centres: np.ndarray
    moving: bool = True
    cost: float = float("inf")


def fit(df: DataFrame, k: int = CLUSTERS, seed: int = SEED, array: str = "sensors", starts: int | None = None, iterations: int = ITERATIONS) -> KMeansModel:
    """k-means on ``array``: the cheapest of ``starts`` fits, each from its own seeds and of at most ``iterations`` rounds."""
    rows = _numbered(df, array)
    best = min(_fitted(rows, [k] * (starts or STARTS), seed, iterations), key=lambda run: run.cost)
    best.moving = True
    _moved(rows, [best], SETTLED, iterations)
    return model_of(df.sparkSession, best.centres)


def _numbered(df: DataFrame, array: str) -> DataFrame:
    """Numbered rows in blocks, as every round reads them again: the number of a block's first row, its readings as bytes, and how many a row has."""
    ship_package(df.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, row = _matrix(batch), batch.column("row")
            many = max(BLOCK_VALUES // max(x.shape[1], 1), 1)
            at = range(0, len(x), many)  # a batch's numbers follow each other
            blocks = pa.array([x[b : b + many].tobytes() for b in at], pa.binary())
            yield pa.RecordBatch.from_arrays([row.take(pa.array(at)), blocks, pa.array([x.shape[1]] * len(at), pa.int32())], ["row", "x", "width"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(array).cast("array<double>").alias("x"))
    return stored(rows.mapInArrow(packed, "row bigint, x binary, width int"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Rows and, if there, their numbers, of plain rows or of blocks, some ``CHUNK_ROWS`` at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch.column("row").to_numpy() if "row" in batch.schema.names else None
        if "width" not in batch.schema.names:
            x = _matrix(batch)
            for at in range(0, len(x), CHUNK_ROWS):
                yield x[at : at + CHUNK_ROWS], None if numbers is None else numbers[at : at + CHUNK_ROWS]
            continue
        some: list[np.ndarray] = []
        begins: list[int] = []
        for i, (block, width) in enumerate(zip(batch.column("x"), batch.column("width").to_pylist())):
            some.append(np.frombuffer(block.as_buffer(), dtype=float).reshape(-1, width))
            begins.append(int(numbers[i]))
            if sum(map(len, some)) >= CHUNK_ROWS or i + 1 == batch.num_rows:
                yield np.concatenate(some), np.concatenate([begin + np.arange(len(part)) for begin, part in zip(begins, some)])
                some, begins = [], []


def _fitted(rows: DataFrame, ks: list[int], seed: int, iterations: int) -> list[Run]:
    """A run for each of ``ks``. All runs share every pass over the rows: one per seed to find, one per round, and one to measure."""
    runs = [Run(centres) for centres in seeds(rows, ks, seed)]
    _moved(rows, runs, TOLERANCE, iterations)
    for run, (_, cost) in zip(runs, step(rows, [run.centres for run in runs])):
        run.cost = cost
    return runs


def _moved(rows: DataFrame, runs: list[Run], tolerance: float, iterations: int) -> None:
    """Move the centres of all moving runs until they move by less than a share of the mean variance."""
    spread = mean_variance(rows, runs[0].centres[0])
    for _ in range(iterations):
        moving = [run for run in runs if run.moving]
        if not moving:
            break
        for run, (centres, _) in zip(moving, step(rows, [run.centres for run in moving])):
            run.moving = bool(((centres - run.centres) ** 2).sum() > tolerance * spread)
            run.centres = centres


def mean_variance(rows: DataFrame, about: np.ndarray) -> float:
    """The mean over the coordinates of their variances, from sums about a point near the rows; 0 without rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(about)))
        for x, _ in _chunks(batches):
            total += np.stack([np.full(len(about), float(len(x))), (x - about).sum(0), ((x - about) ** 2).sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.arange(len(about)), *total)], ["place", "n", "one", "two"])

    sums = rows.mapInArrow(partial, "place bigint, n double, one double, two double").groupBy("place").agg(*[F.sum(c).alias(c) for c in ("n", "one", "two")])
    return sums.filter("n > 0").agg(F.avg(F.expr("greatest(two / n - one / n * one / n, 0)"))).first()[0] or 0.0


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(batch.num_rows, -1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Square distances of all rows to all centres."""
    return np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T, 0.0)


def seeds(rows: DataFrame, ks: list[int], seed: int) -> list[np.ndarray]:
    """Seeds of each run by k-means++: rows drawn in turn with a chance in proportion to their square distance from the seeds so far.

    A row's draw is the smallest of exponential numbers divided by the weights, which tasks can find apart: one row per task and run is shuffled. A run
    of more clusters than there are distinct rows repeats a row.
    """
    found: list[list[np.ndarray]] = [[] for _ in ks]
    for turn in range(max(ks)):
        open_runs = [i for i, k in enumerate(ks) if turn < k]
        chosen = [np.array(found[i]) for i in open_runs]

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, list]] = {}
            for x, numbers in _chunks(batches):
                row = numbers.astype(np.uint64)
                for i, centres in zip(open_runs, chosen):
                    weight = _squares(x, centres).min(1) if len(centres) else np.ones(len(x))
                    key = -np.log(_uniform(row, seed, i, turn)) / np.maximum(weight, 1e-300)
                    at = int(key.argmin())
                    if i not in best or key[at] < best[i][0]:
                        best[i] = (float(key[at]), x[at].tolist())
            kinds = (pa.int64(), pa.float64(), pa.list_(pa.float64()))
            columns = zip(*((i, key, point) for i, (key, point) in best.items())) if best else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["run", "key", "point"])

        drawn = rows.mapInArrow(draw, "run bigint, key double, point array<double>").groupBy("run").agg(F.min_by("point", "key").alias("point"))
        for r in drawn.collect():  # one row per run
            found[r["run"]].append(np.array(r["point"]))
    return [np.array(f) for f in found]


def _uniform(row: np.ndarray, *salt: int) -> np.ndarray:
    """A number between 0 and 1 for each row, the same in every pass."""
    value = row * np.uint64(0x9E3779B97F4A7C15) + np.random.default_rng(salt).integers(0, 1 << 63, dtype=np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        value = (value ^ (value >> np.uint64(30))) * np.uint64(factor)
    return ((value ^ (value >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 1e-17


def step(rows: DataFrame, runs: list[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """For each run's centres, the means of the rows (x) nearest to each, the lower centre on ties, and the cost before the move.

    A centre without rows stays. One aggregation for all runs: a task sends one sum per run, centre and coordinate.
    """
    ship_package(rows.sparkSession)
    widths = [len(c) * (c.shape[1] + 1) + 1 for c in runs]
    begins = np.concatenate([[0], np.cumsum(widths)])
    alike = [[i for i, c in enumerate(runs) if len(c) == k] for k in sorted({len(c) for c in runs})]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(begins[-1])
        sums = [0.0] * len(alike)
        for x, _ in _chunks(batches):
            own, ones = (x**2).sum(1), np.ones((len(x), 1))
            for g, some in enumerate(alike):
                # Runs of as many centres at once, with the rows along the last axis, so that every operation runs through memory in order.
                centres = np.stack([runs[i] for i in some])
                flat = centres.reshape(-1, centres.shape[2])
                squares = (flat @ x.T * -2 + (flat**2).sum(1)[:, None]).reshape(*centres.shape[:2], -1)
                best, nearest = squares[:, 0].copy(), np.zeros(squares[:, 0].shape, dtype=np.int16)
                for c in range(1, centres.shape[1]):
                    nearest[squares[:, c] < best] = c
                    np.minimum(best, squares[:, c], out=best)
                member = (nearest[:, None, :] == np.arange(centres.shape[1], dtype=np.int16)[:, None]).astype(float)
                sums[g] = sums[g] + (member.reshape(len(flat), -1) @ np.concatenate([x, ones], axis=1))
                total[begins[np.array(some) + 1] - 1] += np.maximum(best + own, 0.0).sum(1)
        for found, some in zip(sums, alike):
            if np.ndim(found):
                for i, table in zip(some, np.split(found, len(some))):
                    total[begins[i] : begins[i + 1] - 1] = table.ravel()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["place", "value"])

    sums = rows.mapInArrow(partial, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros(begins[-1])
    total[sums["place"]] = sums["value"]
    moved = []
    for centres, begin, end in zip(runs, begins, begins[1:]):
        table = total[begin : end - 1].reshape(len(centres), -1)
        n = table[:, -1:]
        moved.append((np.where(n > 0, table[:, :-1] / np.maximum(n, 1), centres), float(total[end - 1])))
    return moved


def model_of(spark: SparkSession, centres: np.ndarray) -> KMeansModel:
    """Spark's own model with these centres."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    points = jvm.java.util.ArrayList()
    for centre in centres.tolist():
        values = gateway.new_array(jvm.double, len(centre))
        for i, value in enumerate(centre):
            values[i] = value
        points.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(points)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"KMeans_{uuid.uuid4().hex[:12]}", inner))
    return model.setFeaturesCol("features").setPredictionCol("cluster")


def assign(model: KMeansModel, df: DataFrame, array: str = "sensors") -> DataFrame:
    return model.transform(with_features(df, array)).drop("features")


def wcss_sweep(df: DataFrame, max_clusters: int = MAX_CLUSTERS, seed: int = SEED, array: str = "sensors",
               starts: int | None = None, iterations: int = ITERATIONS) -> list[tuple[int, float]]:
    """Within-cluster sum of squares for k = 1..max_clusters, each the cheapest of several starts."""
    sweep = [(1, float(wcss_of_one(df, array).first()["wcss"]))]  # one cluster has a closed form
    ks = [k for k in range(2, max_clusters + 1) for _ in range(starts or STARTS)]
    costs: dict[int, float] = {}
    for k, run in zip(ks, _fitted(_numbered(df, array), ks, seed, iterations) if ks else []):
        costs[k] = min(costs.get(k, float("inf")), run.cost)
    return sweep + sorted(costs.items())


def sweep_table(spark: SparkSession, sweep: list[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame(sweep, "k int, wcss double")


def square_distance(array: Column, centre: Column) -> Column:
    return F.aggregate(
        F.zip_with(array, centre, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda total, square: total + square
    )


def nearest_centre(array: Column, centres: list[list[float]]) -> Column:
    """Index of the nearest of a few given centres, the lower index on ties."""
    distances = F.array(*[square_distance(array, constants.doubles(c)) for c in centres])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def wcss_of_one(df: DataFrame, array: str = "sensors") -> DataFrame:
    """Closed form of the cost at k = 1: total squared deviation from the mean, per coordinate then summed."""
    per_position = (
        df.select(F.posexplode(array).alias("position", "value"))
        .groupBy("position")
        .agg((F.var_pop("value") * F.count("value")).alias("square"))
    )
    return per_position.agg(F.sum("square").alias("wcss"))


def distinct_clusters(df: DataFrame) -> list[int]:
    return sorted(r["cluster"] for r in df.select("cluster").distinct().collect())

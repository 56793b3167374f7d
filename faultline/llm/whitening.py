"""Whitening of embeddings on leading components, found by contour integration (FEAST).

Spark makes the sums over all vectors, one small partial result per task: the sums per dimension, then the products of the centred vectors. The
covariance, of the vectors' length squared, is solved on the driver: counts of eigenvalues below a shift, by the inertia of an LDL^T factorisation,
bracket the interval that holds the wanted ones and the largest. A quadrature of shifted complex solves around that interval projects a
random block on their eigenspace, Rayleigh-Ritz extracts the components, and the inertia says whether one was missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from faultline.session import ship_package, stored

COMPONENTS = 4
SCALE = 256
NODES = 16  # of the quadrature, on the upper half of the contour
ROUNDS = 40
SEED = 42
TINY = 1e-13  # of the trace: below, an eigenvalue counts as zero


def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are less than ``shift``: negative pivots of a Bunch-Parlett factorisation."""
    rest = matrix - shift * np.eye(len(matrix))
    negative = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        off = np.abs(rest - np.diag(np.diagonal(rest)))
        p = int(diagonal.argmax())
        r, s = np.unravel_index(off.argmax(), off.shape)
        if diagonal[p] == 0 and off[r, s] == 0:
            break
        pivots = [p] if diagonal[p] >= 0.6404 * off[r, s] else [int(r), int(s)]
        others = np.setdiff1d(np.arange(len(rest)), pivots)
        corner, side = rest[np.ix_(pivots, pivots)], rest[np.ix_(others, pivots)]
        # A two by two pivot is taken only where its determinant is negative: one eigenvalue of each sign.
        negative += int(len(pivots) == 2 or corner[0, 0] < 0)
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(corner, side.T)
        rest = (rest + rest.T) / 2
    return negative


def interval(matrix: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """Bounds that hold the ``wanted`` largest eigenvalues, in the middle of the gap below them, and how many are inside (more on ties)."""
    n, top = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    high = top * (1 + 1e-9)
    above = lambda shift: n - below(matrix, shift)

    def last_with(count: int) -> tuple[float, float]:
        """Neighbouring shifts: at least so many eigenvalues above the first, fewer above the second."""
        low, up = -high, high
        while up - low > 1e-12 * top:
            middle = (low + up) / 2
            low, up = (middle, up) if above(middle) >= count else (low, middle)
        return low, up

    floor = -high
    if wanted < n:
        smallest, next_one = last_with(wanted)[0], last_with(wanted + 1)[1]
        floor = (smallest + next_one) / 2 if smallest > next_one else smallest - 1e-9 * top
    return floor, high, above(floor)


def feast(matrix: np.ndarray, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    n = len(matrix)
    low, high, inside = interval(matrix, wanted)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - points)
    norm = np.abs(matrix).sum(axis=1).max()
    block = np.random.default_rng(seed).normal(size=(n, min(n, 2 * inside + 4)))
    best = None
    for _ in range(ROUNDS):
        projected = np.zeros_like(block)
        for angle, weight in zip(angles, weights):
            turn = radius * np.exp(1j * angle)
            projected += (weight / 2 * turn * np.linalg.solve((centre + turn) * np.eye(n) - matrix, block)).real
        basis = np.linalg.qr(projected)[0]
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ inner
        residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        held = np.flatnonzero((values > low) & (values < high))
        if len(held) == inside and (best is None or residual[held].max() < best[0]):
            better = best is None or residual[held].max() < best[0] / 2
            best = residual[held].max(), values[held][::-1], vectors[:, held].T[::-1]
            if best[0] <= 4e-16 * norm or not better:
                break
        elif best is not None:
            break
        block = vectors
    if best is None or best[0] > 1e-10 * norm:
        raise ArithmeticError(f"{inside} eigenvalues lie in the interval, the projection did not find them all")
    return best[1][:wanted], best[2][:wanted]


def fixed(entry: Column) -> Column:
    return F.floor(entry.cast("double") * SCALE).cast("long")


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x: the rows whose vector is there and all finite, in fixed point; one shorter than the longest ends in zeros."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = rows.filter(vector.isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col(id_col).alias("vec_id"), F.transform(vector, fixed).alias("x"))
    width = whole.agg(F.max(F.size("x"))).first()[0] or 0
    return whole.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), width - F.size("x"))))


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(fit: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all vectors of ``part`` (rows to ``size`` numbers): one partial sum per task, added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                added = part(matrix_of(batch.column("x"), width))
                total = added if total is None else total + added
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.ravel().astype(float))], ["place", "value"])

    added = fit.select("x").mapInArrow(partial, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for row in added.collect():  # one row per entry
        out[row["place"]] = row["value"]
    return out


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        centred = x - np.array([s / self.n for s in self.sums])
        return centred @ self.vectors.T / np.sqrt(self.values)


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct vector of ``rows`` (x) once. Components whose eigenvalue is zero are left out."""
    ship_package(rows.sparkSession)
    fit = stored(rows.select("x").distinct())
    n, width = fit.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not width:
        return Whitening(n, [], np.empty(0), np.empty((0, 0)), 0.0, 0.0)
    places = fit.select(F.posexplode("x").alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {r["place"]: int(r["value"]) for r in places.collect()}  # one row per dimension
    sums = [found[i] for i in range(width)]
    means = np.array([s / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - means
        return centred.T @ centred

    covariance = summed(fit, width, products, width * width).reshape(width, width) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    if not trace > 0:
        return Whitening(n, sums, np.empty(0), np.empty((0, width)), trace, 0.0)
    wanted = min(components, width - below(covariance, TINY * trace))
    values, vectors = feast(covariance, wanted)
    model = Whitening(n, sums, values, vectors, trace, 0.0)
    products_of_whitened = summed(fit, width, lambda x: model.project(x).T @ model.project(x), wanted * wanted)
    model.identity_error = float(np.abs(products_of_whitened.reshape(wanted, wanted) / n - np.eye(wanted)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exact; none beyond 64 bits."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    most = max((max(abs(n * low - s), abs(n * high - s)) for s in sums), default=0)
    if most * most * max(len(sums), 1) < 1 << 63:
        apart = n * x - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows with a null vector, or one that holds a null or an infinite or undefined entry, have no result. Repeated vectors count once in the fit and each
    get their rows; a null id stays null. Vectors shorter than the longest end in zeros. Where all vectors are equal, or none is left, there is no
    component and no row. ``deviation`` is null beyond 64 bits. Other columns are ignored.
    """
    usable = whole_vectors(rows, id_col, vector_col)
    model = fitted(usable, components)
    width, kept = len(model.sums), len(model.values)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                        ("explained", pa.float64()), ("identity_error", pa.float64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and kept:
                x = matrix_of(batch.column("x"), width)
                at, component = np.repeat(np.arange(len(x)), kept), np.tile(np.arange(kept), len(x))
                columns = [batch.column("vec_id").take(pa.array(at)), component + 1, np.full(len(at), model.n),
                           pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(at)), model.project(x).ravel(),
                           (model.values / model.trace)[component], np.full(len(at), model.identity_error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    named = usable.withColumn("vec_id", F.col("vec_id").cast("long"))
    return named.mapInArrow(apply, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")

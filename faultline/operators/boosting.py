"""Second-order gradient boosting of trees for two classes.

Each round fits a tree to the gradients and curvatures of the logistic loss at the margins so far. A level of the tree is one aggregation: every
task sums gradient and curvature of its rows per open node, sensor and bin, Spark adds those sums up, and the driver, which sees one number pair per
node, sensor and bin, picks for each node the split of largest gain. Gaps have a bin of their own and go to the side where that gains more.
Leaves take a Newton step with a penalty on their weight; a split must gain more than the price of a leaf.

A node of at most ``LOCAL_VALUES`` readings is finished, with all nodes below, by one task that holds its rows: the same sums, splits and weights, in one
job per tree instead of one per level. Rows are stored in blocks of ``BLOCK_ROWS``, a byte per bin, and travel to these tasks as parts of blocks; every
``FOLD_ROUNDS`` rounds the trees since then are folded into a stored margin, as every pass evaluates those that are not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions import literal_arrays as constants
from faultline.session import ship_package, stored

# Defaults of the original library.
ROUNDS, RATE, DEPTH = 100, 0.3, 6
WEIGHT_PENALTY, LEAF_PRICE, LEAST_CURVATURE = 1.0, 0.0, 1.0
BINS = 32
GAP = BINS  # bin of a missing reading
FOLD_ROUNDS = 5
BLOCK_ROWS = 1 << 12
LOCAL_VALUES = 1 << 22
SAME = 1e-9  # gains that differ by less are equal, whatever the order in which their sums were added up


@dataclass
class Tree:
    """Nodes numbered from 1, the children of i at 2 i and 2 i + 1; ``cut`` is a bin while fitting and a threshold once finished."""

    depth: int
    position: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    gap_left: np.ndarray = field(init=False)
    split: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)

    def __post_init__(self):
        nodes = 1 << (self.depth + 1)
        self.position, self.cut, self.weight = np.zeros(nodes, dtype=np.int64), np.zeros(nodes), np.zeros(nodes)
        self.gap_left, self.split = np.zeros(nodes, dtype=bool), np.zeros(nodes, dtype=bool)

    def leaf_of(self, values: np.ndarray, missing: np.ndarray) -> np.ndarray:
        node = np.ones(len(values), dtype=np.int64)
        rows = np.arange(len(values))
        for _ in range(self.depth):
            at = self.position[node]
            left = np.where(missing[rows, at], self.gap_left[node], values[rows, at] <= self.cut[node])
            node = np.where(self.split[node], 2 * node + ~left, node)
        return node

    def params(self, points: list[list[float]]) -> list[list]:
        """Node, sensor, threshold, gaps to the left, weight; of the nodes in use. A leaf has no sensor."""
        rows, nodes = [], [1]
        while nodes:
            i = nodes.pop()
            if self.split[i]:
                rows.append([i, int(self.position[i]), float(points[self.position[i]][int(self.cut[i])]), bool(self.gap_left[i]), 0.0])
                nodes += [2 * i, 2 * i + 1]
            else:
                rows.append([i, -1, 0.0, False, float(self.weight[i])])
        return rows

    @classmethod
    def of(cls, depth: int, rows: list[list]) -> "Tree":
        tree = cls(depth)
        for i, position, cut, gap_left, weight in rows:
            tree.split[i], tree.position[i], tree.cut[i], tree.gap_left[i], tree.weight[i] = position >= 0, max(position, 0), cut, gap_left, weight
        return tree


def split_points(train: DataFrame, bins: int = BINS) -> list[list[float]]:
    """Candidate thresholds per sensor: approximate quantiles, without the highest value, which splits nothing off."""
    rows = (
        train.select(F.posexplode("sensors").alias("position", "value"))
        .groupBy("position")
        .agg(F.percentile_approx("value", [i / bins for i in range(1, bins)], 10_000).alias("points"), F.max("value").alias("top"))
        .orderBy("position")
        .collect()  # one row per sensor
    )
    return [sorted({p for p in r["points"] or [] if p < r["top"]}) for r in rows]


def binned(array: Column, points: list[list[float]]) -> Column:
    """For each sensor, how many thresholds its value exceeds, or the bin of gaps."""
    edges = constants.double_rows(points)
    return F.transform(array, lambda x, i: F.when(x.isNull(), GAP).otherwise(F.size(F.filter(F.get(edges, i), lambda edge: edge < x))))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def best_splits(gradient: np.ndarray, curvature: np.ndarray, valid: np.ndarray, penalty: float, price: float, least: float) -> list[tuple | None]:
    """For each node the sensor, bin and side of gaps of largest gain, or none; sums are by node, sensor and bin, gaps last.

    Of equal gains the first sensor and bin win, with gaps to the left.
    """
    all_g, all_h = gradient.sum(2)[:, :1], curvature.sum(2)[:, :1]
    gains = []
    for gaps in (1, 0):
        left_g = gradient[:, :, :-1].cumsum(2) + gaps * gradient[:, :, -1:]
        left_h = curvature[:, :, :-1].cumsum(2) + gaps * curvature[:, :, -1:]
        right_g, right_h = all_g[..., None] - left_g, all_h[..., None] - left_h
        gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - (all_g**2 / (all_h + penalty))[..., None]
        gains.append(np.where(valid & (left_h >= least) & (right_h >= least), gain / 2 - price, -np.inf))
    gain = np.stack(gains, axis=3)
    found = []
    for node in gain:
        most = node.max()
        at = np.unravel_index((node >= most * (1 - SAME)).argmax(), node.shape)
        found.append((int(at[0]), int(at[1]), bool(at[2] == 0)) if most > SAME else None)
    return found


@dataclass
class Rules:
    """How trees grow; ``valid`` says which bins of a sensor are thresholds."""

    rate: float
    depth: int
    penalty: float
    price: float
    least: float
    valid: np.ndarray

    def can_split(self, node: int, curvature: float) -> bool:
        return node < 1 << self.depth and curvature >= 2 * self.least

    def grown(self, node: int, total: np.ndarray) -> tuple[tuple | None, list[float]]:
        """A node's split, if any, and the weights of the node and of both children, from its sums by sensor and bin."""
        gradient, curvature = total[0], total[1]
        split = best_splits(gradient, curvature, self.valid, self.penalty, self.price, self.least)[0] if self.can_split(node, curvature[0, 0].sum()) else None
        sides = [(gradient[0, 0].sum(), curvature[0, 0].sum())]
        if split:
            at, cut, gap_left = split
            sides.append(tuple(sums[0, at, : cut + 1].sum() + gap_left * sums[0, at, -1] for sums in (gradient, curvature)))
            sides.append((sides[0][0] - sides[1][0], sides[0][1] - sides[1][1]))
        return split, [-self.rate * g / (h + self.penalty) for g, h in sides]


BLOCKS = "bins binary, label binary, margin binary, n int"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bins and a label as blocks, their margins 0."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bins, label = _matrix(batch, "bins").astype(np.uint8), batch.column("label").to_numpy()
        cuts = [slice(b, b + BLOCK_ROWS) for b in range(0, len(bins), BLOCK_ROWS)]
        yield _block_batch([(bins[cut], label[cut], np.zeros(len(label[cut]))) for cut in cuts])


def _block_batch(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array([part.tobytes() for part in side], pa.binary()) for side in zip(*blocks)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([len(b[0]) for b in blocks], pa.int32())], ["bins", "label", "margin", "n"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins, labels and margins, block by block."""
    for batch in batches:
        for bins, label, margin, n in zip(*(batch.column(c) for c in ("bins", "label", "margin", "n"))):
            bins = np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape(n.as_py(), -1)
            yield bins, np.frombuffer(label.as_buffer()), np.frombuffer(margin.as_buffer())


def added(bins: np.ndarray, margin: np.ndarray, trees: list[Tree]) -> np.ndarray:
    total, missing = margin.copy(), bins == GAP
    for tree in trees:
        total += tree.weight[tree.leaf_of(bins, missing)]
    return total


def standing(block: tuple[np.ndarray, ...], trees: list[Tree], tree: Tree) -> tuple[np.ndarray, ...]:
    """Bins, gradient, curvature and node in the growing tree of a block's rows."""
    bins, label, margin = block
    chance = 1 / (1 + np.exp(-added(bins, margin, trees)))
    return bins, chance - label, chance * (1 - chance), tree.leaf_of(bins, bins == GAP)


class Booster:
    """State of a fit: the trees so far and the rows with bins, label and the margin of folded trees."""

    def __init__(self, train: DataFrame, rate: float, depth: int, penalty: float, price: float, least: float):
        ship_package(train.sparkSession)
        self.points = split_points(train)
        valid = np.array([[b < len(p) for b in range(BINS)] for p in self.points]).reshape(len(self.points), BINS)
        self.rules = Rules(rate, depth, penalty, price, least, valid)
        rows = train.select(binned(F.col("sensors"), self.points).alias("bins"), F.col("label").cast("double").alias("label"))
        self.rows = stored(rows.mapInArrow(_packed, BLOCKS))
        self.size = self.rows.agg(F.sum("n")).first()[0] or 0
        self.trees: list[Tree] = []
        self.folded = 0

    def fold(self) -> None:
        """Store the rows with the margins of all trees so far."""
        trees = self.trees[self.folded :]

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, label, margin in _blocks(batches):
                yield _block_batch([(bins, label, added(bins, margin, trees))])

        self.rows = stored(self.rows.mapInArrow(moved, BLOCKS))
        self.folded = len(self.trees)

    def sums(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        """Gradient, curvature and rows by node of ``nodes``, sensor and bin."""
        trees, width = self.trees[self.folded :], len(self.points)
        slot = np.full(len(tree.split), -1)
        slot[nodes] = np.arange(len(nodes))
        size = len(nodes) * width * (BINS + 1)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, size))
            for block in _blocks(batches):
                bins, gradient, curvature, node = standing(block, trees, tree)
                kept = slot[node] >= 0
                total += histogram(bins[kept], gradient[kept], curvature[kept], slot[node[kept]], size)
            used = np.flatnonzero(total[2])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (used, *total[:, used])], ["place", "g", "h", "n"])

        cells = self.rows.mapInArrow(partial, "place bigint, g double, h double, n double").groupBy("place").agg(*[F.sum(c).alias(c) for c in "ghn"]).toPandas()
        total = np.zeros((3, size))
        total[:, cells["place"]] = cells[["g", "h", "n"]].to_numpy().T
        return total.reshape(3, len(nodes), width, BINS + 1)

    def finish(self, tree: Tree, nodes: list[int]) -> None:
        """Grow everything below some small nodes, one task for each."""
        trees, rules, width = self.trees[self.folded :], self.rules, len(self.points)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                bins, gradient, curvature, node = standing(block, trees, tree)
                here = [n for n in nodes if (node == n).any()]
                parts = [[side[node == n].tobytes() for n in here] for side in (bins, gradient, curvature)]
                yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), *(pa.array(p, pa.binary()) for p in parts)], ["node", "bins", "g", "h"])

        def local(rows: pa.Table) -> pa.Table:
            bins, gradient, curvature = (
                np.concatenate([np.frombuffer(part.as_buffer(), dtype=kind) for part in rows.column(c)]) for c, kind in (("bins", np.uint8), ("g", float), ("h", float)))
            bins = bins.reshape(len(gradient), width)
            found, open_nodes = [], {rows.column("node")[0].as_py(): np.arange(len(gradient))}
            while open_nodes:
                node, at = open_nodes.popitem()
                total = histogram(bins[at], gradient[at], curvature[at], np.zeros(len(at), dtype=np.int64), bins.shape[1] * (BINS + 1)).reshape(3, 1, bins.shape[1], BINS + 1)
                split, weights = rules.grown(node, total)
                found.append((node, *(split or (-1, 0, False)), weights[0]))
                if split:
                    codes = bins[at, split[0]]
                    left = np.where(codes == GAP, split[2], codes <= split[1])
                    for child, part, weight in ((2 * node, at[left], weights[1]), (2 * node + 1, at[~left], weights[2])):
                        if rules.can_split(child, curvature[part].sum()):
                            open_nodes[child] = part
                        else:
                            found.append((child, -1, 0, False, weight))
            names = ["node", "position", "cut", "gap_left", "weight"]
            return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.float64()))], names)

        rows = self.rows.mapInArrow(placed, "node bigint, bins binary, g binary, h binary")
        for r in rows.groupBy("node").applyInArrow(local, "node bigint, position bigint, cut bigint, gap_left boolean, weight double").collect():  # a tree's nodes
            tree.split[r["node"]], tree.position[r["node"]], tree.cut[r["node"]] = r["position"] >= 0, max(r["position"], 0), r["cut"]
            tree.gap_left[r["node"]], tree.weight[r["node"]] = r["gap_left"], r["weight"]

    def grow(self) -> Tree:
        """The next tree: large nodes level by level, then all small ones at once."""
        tree, width = Tree(self.rules.depth), max(len(self.points), 1)
        large, small = ([1], []) if self.size * width > LOCAL_VALUES else ([], [1])
        while large:
            total, following = self.sums(tree, large), []
            for i, node in enumerate(large):
                split, weights = self.rules.grown(node, total[:, i : i + 1])
                tree.weight[node] = weights[0]
                if split:
                    at, cut, gap_left = split
                    tree.split[node], tree.position[node], tree.cut[node], tree.gap_left[node] = True, at, cut, gap_left
                    tree.weight[2 * node], tree.weight[2 * node + 1] = weights[1:]
                    left = total[1:, i, at, : cut + 1].sum(1) + gap_left * total[1:, i, at, -1]
                    for child, (h, n) in ((2 * node, left), (2 * node + 1, total[1:, i, at].sum(1) - left)):
                        if self.rules.can_split(child, h):
                            (following if n * width > LOCAL_VALUES else small).append(child)
            large = following
        if small:
            self.finish(tree, small)
        return tree


def histogram(bins: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, slot: np.ndarray, size: int) -> np.ndarray:
    """Sums of gradient, curvature and rows by slot, sensor and bin."""
    width = bins.shape[1]
    place = ((slot[:, None] * width + np.arange(width)) * (BINS + 1) + bins).ravel()
    return np.stack([np.bincount(place, np.repeat(gradient, width), size), np.bincount(place, np.repeat(curvature, width), size), np.bincount(place, minlength=size)])


def fit(train: DataFrame, rounds: int = ROUNDS, rate: float = RATE, depth: int = DEPTH, penalty: float = WEIGHT_PENALTY, price: float = LEAF_PRICE,
        least: float = LEAST_CURVATURE) -> dict:
    """Trees fitted on (sensors, label 0/1), as plain parameters. Rows may have gaps; an even chance is the start."""
    booster = Booster(train, rate, depth, penalty, price, least)
    for _ in range(rounds):
        if len(booster.trees) - booster.folded == FOLD_ROUNDS:
            booster.fold()
        tree = booster.grow()
        booster.trees.append(tree)
        if not tree.split[1] and abs(tree.weight[1]) < 1e-9:
            break  # nothing is left to gain, now or later
    return {"depth": depth, "trees": [tree.params(booster.points) for tree in booster.trees]}


def margin(params: dict):
    """The sum of the leaves' weights, as a function of the sensor array."""

    @F.pandas_udf("double")
    def total(sensors: pd.Series) -> pd.Series:
        if not len(sensors):
            return pd.Series([], dtype=float)
        values = np.array([[np.nan if x is None else x for x in row] for row in sensors], dtype=float)
        missing = np.isnan(values)
        out = np.zeros(len(values))
        for rows in params["trees"]:
            tree = Tree.of(params["depth"], rows)
            out += tree.weight[tree.leaf_of(values, missing)]
        return pd.Series(out)

    return total


def score(df: DataFrame, params: dict) -> DataFrame:
    """Adds ``probability`` of class 1 and ``prediction``."""
    ship_package(df.sparkSession)
    chance = 1 / (1 + F.exp(-margin(params)("sensors")))
    return df.withColumn("probability", chance).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

"""A random forest whose trees are a stored table, grown and asked by tasks.

Trees grow as in Spark's own forest: on rows drawn with Poisson weights, each node on the best Gini split of a few sensors drawn for it, over quantile bins.
Fully grown trees are about as large as the data, so they never meet in the driver:

1. a node of more than ``LOCAL_VALUES`` readings is split by one aggregation per level, over all trees at once. Tasks sum weights per sensor and bin, one group
   picks a node's split, and the driver sees one row per large node;
2. every smaller node goes with its rows' bins, a byte each, to one task that grows the whole subtree and returns it as one row of the table;
3. scoring sends rows, as bins, to the subtrees that they reach, and sums up the leaves' shares of class 1.

Rows travel packed, one record per batch, tree and node. Trees are grown in passes of about ``PASS_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from faultline.operators.boosting import split_points
from faultline.operators.clustering import _uniform
from faultline.session import ship_package, stored

BINS = 32
LOCAL_VALUES = 1 << 24
PASS_BYTES = 1 << 30
NODES_AT_ONCE = 4096  # of a level, in a task
PACKS_AT_ONCE = 64  # of rows to score, for one subtree in one task
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))
SAME = 1e-9

SUBTREES = "tree int, root int, sensor array<int>, cut array<int>, child array<int>, share array<double>"
PACKED = "tree int, root int, bins binary, weight binary, label binary"


def binned(values: np.ndarray, points: list[list[float]]) -> np.ndarray:
    """For each sensor how many thresholds its value exceeds, a byte each; a gap exceeds all."""
    out = np.empty(values.shape, dtype=np.uint8)
    for at, edges in enumerate(points):
        out[:, at] = np.searchsorted(np.array(edges), values[:, at], "left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, width)


def weights_of(row: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for the tree, the same in every pass."""
    return np.searchsorted(POISSON, _uniform(row.astype(np.uint64), seed, tree)).astype(np.uint8)


class Flat:
    """A tree as lists; ``child`` is the place of the left child, before the right one, or -1 at a leaf."""

    def __init__(self, sensor=(), cut=(), child=(), share=()):
        self.sensor, self.cut, self.child, self.share = list(sensor), list(cut), list(child), list(share)

    def add(self, share: float) -> int:
        self.sensor.append(0), self.cut.append(0), self.child.append(-1), self.share.append(share)
        return len(self.child) - 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        sensor, cut, child = (np.array(c, dtype=np.int64) for c in (self.sensor, self.cut, self.child))
        node, active = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while len(active):
            below = child[node[active]]
            active, below = active[below >= 0], below[below >= 0]
            at = node[active]
            node[active] = below + (bins[active, sensor[at]] > cut[at])
        return node


def drawn_sensors(seed: int, tree: int, root: int, level: int, nodes: int, width: int, some: int) -> np.ndarray:
    rng = np.random.default_rng((seed, tree, root, level))
    return np.argsort(rng.random((nodes, width)), axis=1)[:, :some]


def sums(bins: np.ndarray, weight: np.ndarray, ones: np.ndarray, slot: np.ndarray, sensors: np.ndarray) -> np.ndarray:
    """Weight, in all and of class 1, by node, drawn sensor and bin."""
    nodes, some = sensors.shape
    place = ((slot[:, None] * some + np.arange(some)) * BINS + bins[np.arange(len(bins))[:, None], sensors[slot]]).ravel()
    size = nodes * some * BINS
    return np.stack([np.bincount(place, np.repeat(v, some), size).reshape(nodes, some, BINS) for v in (weight, ones)])


def best_splits(total: np.ndarray) -> tuple[np.ndarray, ...]:
    """By node: whether a split gains, the place of its sensor among the drawn ones, its bin, and the weight left and right, in all and of class 1."""
    left, left1 = total.cumsum(3)
    whole, whole1 = left[:, :1, -1:], left1[:, :1, -1:]
    right, right1 = whole - left, whole1 - left1
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = (left1**2 + (left - left1) ** 2) / left + (right1**2 + (right - right1) ** 2) / right
        before = ((whole1**2 + (whole - whole1) ** 2) / whole)[:, 0, 0]
    pure = np.where((left > 0) & (right > 0), pure, -np.inf).reshape(len(left), -1)
    at = pure.argmax(1)
    node = np.arange(len(at))
    gains = pure[node, at] > before + SAME * whole[:, 0, 0]
    sides = [a.reshape(len(at), -1)[node, at] for a in (left, left1, right, right1)]
    return gains, at // BINS, at % BINS, *sides


def grown(bins: np.ndarray, weight: np.ndarray, label: np.ndarray, tree: int, root: int, depth: int, some: int, seed: int) -> Flat:
    """The subtree of these rows, level by level."""
    flat, ones = Flat(), weight * label
    flat.add(ones.sum() / weight.sum())
    open_nodes = np.array([0] if 0 < ones.sum() < weight.sum() else [], dtype=np.int64)
    rows, slot = np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
    for level in range(depth):
        if not len(open_nodes):
            break
        sensors = drawn_sensors(seed, tree, root, level, len(open_nodes), bins.shape[1], some)
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        begins = np.searchsorted(slot, np.arange(0, len(open_nodes), NODES_AT_ONCE))
        next_open, next_rows, next_slot = [], [], []
        for i, (b, e) in enumerate(zip(begins, np.append(begins[1:], len(rows)))):
            first, at, of = i * NODES_AT_ONCE, rows[b:e], slot[b:e] - i * NODES_AT_ONCE
            drawn = sensors[first : first + NODES_AT_ONCE]
            gains, place, cut, left, left1, right, right1 = best_splits(sums(bins[at], weight[at], ones[at], of, drawn))
            sensor = drawn[np.arange(len(drawn)), place]
            child = np.full((len(drawn), 2), -1)  # the next slots of both children
            for n in np.flatnonzero(gains):
                node = open_nodes[first + n]
                low = flat.add(left1[n] / left[n])
                high = flat.add(right1[n] / right[n])
                flat.sensor[node], flat.cut[node], flat.child[node] = int(sensor[n]), int(cut[n]), low
                for side, (name, all_of, of_one) in enumerate(((low, left[n], left1[n]), (high, right[n], right1[n]))):
                    if 0 < of_one < all_of:
                        child[n, side] = len(next_open)
                        next_open.append(name)
            to = child[of, (bins[at, sensor[of]] > cut[of]).astype(np.int64)]
            next_rows.append(at[to >= 0]), next_slot.append(to[to >= 0])
        open_nodes, rows, slot = np.array(next_open, dtype=np.int64), np.concatenate(next_rows), np.concatenate(next_slot)
    return flat


def _pieces(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(owner, kind="stable")
    names, begins = np.unique(owner[order], return_index=True)
    for name, at in zip(names, np.split(order, begins[1:])):
        yield int(name), at


def _bytes(column: pa.ChunkedArray, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(*shape)


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        if batch.num_rows:
            bins = _bytes(pa.chunked_array([batch.column("bins")]), batch.num_rows, width)
            yield bins, batch.column("row").to_numpy(), batch.column("label").to_numpy().astype(np.uint8)


class Grower:
    """The rows, binned, and the top of every tree: the nodes that are too large for one task."""

    def __init__(self, train: DataFrame, trees: int, depth: int, seed: int, local_values: int):
        ship_package(train.sparkSession)
        self.points = points = split_points(train, BINS)
        if not points:
            raise ValueError("no rows to learn from")
        self.width, self.depth, self.seed, self.local = len(points), depth, seed, max(1, local_values // len(points))
        self.some = min(self.width, int(np.ceil(np.sqrt(self.width))))
        width = self.width

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = binned(_matrix(batch.column("sensors"), width), points)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([b.tobytes() for b in bins], pa.binary()), batch.column("label")], ["row", "bins", "label"])

        numbered = train.select(F.xxhash64("row_key").alias("row"), "sensors", F.col("label").cast("int").alias("label"))
        self.rows = stored(numbered.mapInArrow(packed, "row bigint, bins binary, label int"))
        self.size, share = self.rows.agg(F.count("*"), F.avg("label")).first()
        self.tops = [Flat() for _ in range(trees)]
        for top in self.tops:
            top.add(share)  # that of a tree for which no row is drawn
        self.ended: list[tuple] = []  # large leaves, as subtrees of one node

    def split_large(self) -> None:
        """Level by level, the nodes of all trees that are too large for one task."""
        open_nodes = [(tree, 0) for tree in range(len(self.tops))] if self.size > self.local else []
        for level in range(self.depth):
            if not open_nodes:
                return
            open_nodes = self._split_level(open_nodes, level)
        for tree, node in open_nodes:
            self.ended.append((tree, node, [0], [0], [-1], [self.tops[tree].share[node]]))

    def _split_level(self, open_nodes: list[tuple[int, int]], level: int) -> list[tuple[int, int]]:
        tops, seed, width, some = self.tops, self.seed, self.width, self.some
        sensors = np.stack([drawn_sensors(seed, tree, node, level, 1, width, some)[0] for tree, node in open_nodes])
        by_tree: dict[int, dict[int, int]] = {}
        for at, (tree, node) in enumerate(open_nodes):
            by_tree.setdefault(tree, {})[node] = at

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, len(open_nodes), some, BINS))
            for bins, row, label in _rows(batches, width):
                for tree, places in by_tree.items():
                    slot_of = np.full(len(tops[tree].child), -1)
                    slot_of[list(places)] = np.arange(len(places))
                    weight, slot = weights_of(row, seed, tree).astype(float), slot_of[tops[tree].leaf_of(bins)]
                    kept = (slot >= 0) & (weight > 0)
                    mine = list(places.values())
                    total[:, mine] += sums(bins[kept], weight[kept], (weight * label)[kept], slot[kept], sensors[mine])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(open_nodes)), pa.int64()), pa.array([total[:, i].tobytes() for i in range(len(open_nodes))], pa.binary())], ["at", "total"])

        def pick(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(t).reshape(2, 1, some, BINS) for t in table.column("total").to_pylist())
            gains, place, cut, *sides = best_splits(total)
            whole, whole1 = total[:, 0, 0].sum(1)
            values = [table.column("at")[0].as_py(), bool(gains[0]), int(place[0]), int(cut[0]), *[float(s[0]) for s in sides], float(whole1 / whole) if whole else 0.0]
            return pa.table([[v] for v in values], names=["at", "gains", "place", "cut", "low", "low1", "high", "high1", "share"])

        found = self.rows.mapInArrow(partial, "at bigint, total binary").groupBy("at").applyInArrow(
            pick, "at bigint, gains boolean, place bigint, cut bigint, low double, low1 double, high double, high1 double, share double")
        following = []
        for r in sorted(found.collect()):  # one row per large node
            tree, node = open_nodes[r["at"]]
            top = tops[tree]
            top.share[node] = r["share"]
            if not r["gains"]:
                self.ended.append((tree, node, [0], [0], [-1], [r["share"]]))
                continue
            low, high = top.add(r["low1"] / r["low"]), top.add(r["high1"] / r["high"])
            top.sensor[node], top.cut[node], top.child[node] = int(sensors[r["at"], r["place"]]), r["cut"], low
            following += [(tree, child) for child, weight in ((low, r["low"]), (high, r["high"])) if weight > self.local]
        return following

    def levels(self, tree: int) -> dict[int, int]:
        """The level of each leaf of a tree's top."""
        found, top = [(0, 0)], self.tops[tree]
        leaves = {}
        while found:
            node, level = found.pop()
            if top.child[node] < 0:
                leaves[node] = level
            else:
                found += [(top.child[node], level + 1), (top.child[node] + 1, level + 1)]
        return leaves

    def subtrees(self, trees: list[int]) -> DataFrame:
        tops, seed, width, some, depth = self.tops, self.seed, self.width, self.some, self.depth
        ended = {(tree, node) for tree, node, *_ in self.ended}
        levels = {tree: self.levels(tree) for tree in trees}

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, row, label in _rows(batches, width):
                for tree in trees:
                    weight = weights_of(row, seed, tree)
                    drawn = np.flatnonzero(weight)
                    pieces = [(root, drawn[at]) for root, at in _pieces(tops[tree].leaf_of(bins[drawn])) if (tree, root) not in ended]
                    columns = [pa.array([tree] * len(pieces), pa.int32()), pa.array([root for root, _ in pieces], pa.int32()),
                               *[pa.array([a[at].tobytes() for _, at in pieces], pa.binary()) for a in (bins, weight, label)]]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "root", "bins", "weight", "label"])

        def grow(table: pa.Table) -> pa.Table:
            tree, root = table.column("tree")[0].as_py(), table.column("root")[0].as_py()
            weight, label = (_bytes(table.column(c), -1).astype(float) for c in ("weight", "label"))
            flat = grown(_bytes(table.column("bins"), -1, width), weight, label, tree, root, depth - levels[tree][root], some, seed)
            return pa.table([pa.array([v], t) for v, t in zip((tree, root, flat.sensor, flat.cut, flat.child, flat.share), (pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.float64())))],
                            names=["tree", "root", "sensor", "cut", "child", "share"])

        return self.rows.mapInArrow(sent, PACKED).groupBy("tree", "root").applyInArrow(grow, SUBTREES)


def fit(train: DataFrame, trees: int, depth: int, seed: int, local_values: int = LOCAL_VALUES) -> tuple[dict, DataFrame]:
    """Plain parameters, and the stored table of subtrees."""
    grower = Grower(train, trees, depth, seed, local_values)
    grower.split_large()
    per_pass = int(np.clip(PASS_BYTES // max(grower.size * grower.width, 1), 1, trees))
    parts = [stored(grower.subtrees(list(range(first, min(first + per_pass, trees))))) for first in range(0, trees, per_pass)]
    if grower.ended:
        parts.append(train.sparkSession.createDataFrame(grower.ended, SUBTREES))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    tops = [[t.sensor, t.cut, t.child, [float(s) for s in t.share]] for t in grower.tops]
    return {"points": [[float(p) for p in edges] for edges in grower.points], "tops": tops}, stored(table) if len(parts) > 1 else table


def score(df: DataFrame, params: dict, table: DataFrame, key: str = "row_key") -> DataFrame:
    """Adds ``probability``, the mean over all trees of the share of class 1 in the row's leaf, and ``prediction``. Keys are unique."""
    spark = df.sparkSession
    ship_package(spark)
    points, tops = params["points"], [Flat(*top) for top in params["tops"]]
    width, trees = len(points), len(tops)
    key_type = df.schema[key].dataType

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                bins = binned(_matrix(batch.column("sensors"), width), points)
                keys = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(key))
                yield pa.RecordBatch.from_arrays([pa.array([task << 32 | at], pa.int64()), pa.array([at], pa.int32()), keys, pa.array([bins.tobytes()], pa.binary())], ["pack", "nth", "keys", "bins"])
                at += 1

    schema = T.StructType([T.StructField("pack", T.LongType()), T.StructField("nth", T.IntegerType()), T.StructField("keys", T.ArrayType(key_type)), T.StructField("bins", T.BinaryType())])
    packs = stored(df.select(key, "sensors").mapInArrow(packed, schema))
    blocks = max(1, -(-packs.count() // PACKS_AT_ONCE))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pack", "tree", "root", "places", "bins"]
        for batch in batches:
            for pack, blob in zip(batch.column("pack").to_pylist(), batch.column("bins")):
                bins = np.frombuffer(blob.as_buffer(), dtype=np.uint8).reshape(-1, width)
                for tree, top in enumerate(tops):
                    pieces = list(_pieces(top.leaf_of(bins)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([pack] * len(pieces), pa.int64()), pa.array([tree] * len(pieces), pa.int32()), pa.array([root for root, _ in pieces], pa.int32()),
                        pa.array([at.astype("<i4").tobytes() for _, at in pieces], pa.binary()), pa.array([bins[at].tobytes() for _, at in pieces], pa.binary())], names)

    def asked(rows: pa.Table, subtree: pa.Table) -> pa.Table:
        flat = Flat(*[subtree.column(c).combine_chunks().flatten().to_numpy() for c in ("sensor", "cut", "child", "share")]) if subtree.num_rows else None
        # A top's leaf that no drawn row reached has no subtree: its top says the share.
        of = tops[rows.column("tree")[0].as_py()].share[rows.column("root")[0].as_py()] if flat is None and rows.num_rows else None
        shares = []
        for blob in rows.column("bins").to_pylist():
            bins = np.frombuffer(blob, dtype=np.uint8).reshape(-1, width)
            shares.append((np.full(len(bins), of) if flat is None else np.array(flat.share)[flat.leaf_of(bins)]).astype("<f8").tobytes())
        return pa.table([rows.column("pack"), rows.column("places"), pa.array(shares, pa.binary())], names=["pack", "places", "shares"])

    def added(rows: pa.Table) -> pa.Table:
        places = [np.frombuffer(p, dtype="<i4") for p in rows.column("places").to_pylist()]
        total = np.zeros(max(p.max() for p in places) + 1)
        for at, shares in zip(places, rows.column("shares").to_pylist()):
            total[at] += np.frombuffer(shares, dtype="<f8")
        return pa.table([rows.column("pack").slice(0, 1), pa.array([np.round(total / trees, 12)], pa.list_(pa.float64()))], names=["pack", "chances"])

    block = F.pmod(F.xxhash64("pack"), F.lit(blocks)).cast("int").alias("block")
    left = packs.select("pack", "bins").mapInArrow(sent, "pack bigint, tree int, root int, places binary, bins binary").select("*", block)
    right = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    votes = left.groupBy("tree", "root", "block").cogroup(right.groupBy("tree", "root", "block")).applyInArrow(asked, "pack bigint, places binary, shares binary")
    chances = votes.groupBy("pack").applyInArrow(added, "pack bigint, chances array<double>")
    listed = packs.select("pack", "keys").join(chances, "pack").select(F.explode(F.arrays_zip("keys", "chances")).alias("r")).select(F.col("r.keys").alias(key), F.col("r.chances").alias("probability"))
    return df.join(listed, key).select(*df.columns, "probability").withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultline.session import ship_package, stored

#: So many edges, of 16 bytes each, are settled by one task; more go through rounds. Both give the same roots.
ONE_TASK = 1 << 18


def connected(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b: longs); the root is the component's smallest node.

    Every round moves each node's larger neighbours to its smallest one and then joins the smaller ones there, until all
    edges point to roots. Each round's edges are stored, so no lineage grows. A node with very many neighbours is
    split by the skew handling of joins; minima combine before they are shuffled. Of at most ``one_task`` edges no round is made.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] <= one_task:
            ship_package(edges.sparkSession)
            return stored(now.coalesce(1).mapInArrow(_settled, "node bigint, root bigint"))
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        before = mark
        now = stored(_small_star(_large_star(now)).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("at"), F.least("a", "low").alias("low"))
    return both.filter("b > a").join(lowest, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("at"), "low")
    moved = edges.join(lowest, F.col("a") == F.col("at"))
    return moved.filter("b != low").select("b", "low").toDF("a", "b").union(lowest.toDF("a", "b"))


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges at once: labels sink along edges and are then replaced by their own labels, until none changes."""
    sides = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not sides:
        return
    a, b = (np.concatenate(side) for side in zip(*sides))
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root, before = np.arange(len(nodes)), None
    while before is None or (root != before).any():
        before, low = root, np.minimum(root[a], root[b])
        root = before.copy()
        for at in (a, b, before[a], before[b]):
            np.minimum.at(root, at, low)
        root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "root"])

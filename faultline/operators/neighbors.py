"""Exact nearest-neighbour fill and vote under missing values.

Distance between two rows is Euclidean over the coordinates present in both, scaled up by
``n_coordinates / n_common``. For every missing coordinate of a query row, its ``k`` nearest rows that have
that coordinate give their mean; ties go to the smaller key.

The work is laid out as a partitioned join, never as a cross join:

1. donors are assigned to cells around a bounded number of pivots, and each cell is summarised by its pivot
   radius, coordinate ranges and counts;
2. every query first searches its most promising cell; the k-th distance found there, or else one bounded from
   the summaries, limits the other cells to those whose lower bound does not exceed it (triangle inequality and
   coordinate ranges, both corrected for missing coordinates), so skipping a cell can never change a result;
3. cells next to each other are packed into donor parts of bounded size, a large cell's rows over several; queries are packed into
   groups in the same way, so any hot spot is many tasks;
4. each (part, group) task compares tiles by products and keeps a local top-k, in the later search within the distance that the first
   one found; one shuffle on the query key merges them. Parts are large, as every part adds ``k`` rows a query and gap to that shuffle.

Pivots only steer the layout. Worst-case work stays rows x incomplete rows, which is inherent in the operator.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from faultline.functions import literal_arrays as constants
from faultline.operators import columns as cols
from faultline.session import ship_package, stored

PART_BYTES, PART_ROWS = 32 << 20, (256, 1 << 16)  # donors of a task
PART_CELLS = 4  # that a part holds, on average: a query's bounds are worked out for every cell
GROUP_ROWS = (256, 1 << 14)  # queries of a task: few groups, as each meets its own copy of the donors
TILE = (1024, 4096)  # queries and donors of a product
ALIKE_ROWS = 64  # rows a pattern of gaps, on average, from which tiles are of one pattern
PAIRS = 1 << 15
MAX_CELLS = 512
SUMMARY_VALUES = 1 << 20  # cells x coordinates that may travel to the driver and to every task
ROUNDING = 1e-9


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(chunk.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, width)


class Layout:
    """Pivots of the donor cells, and after ``summarise`` the bounds of each cell."""

    def __init__(self, pivots: np.ndarray, means: np.ndarray):
        self.pivots = pivots
        self.means = means
        self.width = pivots.shape[1]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row, and the distance to it over the row's own coordinates."""
        missing = np.isnan(x)
        full = np.where(missing, self.means, x)
        square = (full**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * full @ self.pivots.T
        cell = square.argmin(1)
        gap = np.where(missing, 0.0, x - self.pivots[cell])
        return cell, np.sqrt((gap**2).sum(1))

    def summarise(self, cells: dict, ranges) -> None:
        n = len(self.pivots)
        self.count = np.zeros(n, dtype=np.int64)
        self.radius = np.zeros(n)
        self.max_missing = np.zeros(n, dtype=np.int64)
        for cell, (count, radius, missing) in cells.items():
            self.count[cell], self.radius[cell], self.max_missing[cell] = count, radius, missing
        self.present = np.zeros((n, self.width), dtype=np.int64)
        self.low = np.full((n, self.width), np.nan)
        self.high = np.full((n, self.width), np.nan)
        at = (ranges["cell"].to_numpy(), ranges["position"].to_numpy())
        self.present[at] = ranges["n"].to_numpy()
        self.low[at] = ranges["low"].to_numpy()
        self.high[at] = ranges["high"].to_numpy()
        self.always = (self.present == self.count[:, None]) & (self.count[:, None] > 0)
        self.sometimes = (self.present > 0) & ~self.always

    def _at_least(self, terms: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Least sum of ``terms`` over the coordinates any donor of the cell shares with the query."""
        sure = np.where(self.always & known, terms, 0.0).sum(1)
        maybe = np.sort(np.where(self.sometimes & known, terms, 0.0), axis=1)
        running = np.concatenate([np.zeros((len(maybe), 1)), maybe.cumsum(1)], axis=1)
        kept = np.maximum(self.width - self.max_missing, 0)
        return sure + running[np.arange(len(maybe)), kept]

    def visits(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells that can hold one of the ``k`` nearest donors of ``q`` for one of its missing coordinates.

        The most promising cell comes first. With each cell goes a lower bound of the squared distance.
        """
        known = ~np.isnan(q)
        x = np.where(known, q, 0.0)
        usable = (self.always | self.sometimes) & known
        n_most = usable.sum(1)
        n_sure = (self.always & known).sum(1)
        n_least = n_sure + np.maximum((self.sometimes & known).sum(1) - self.max_missing, 0)
        below, above = np.nan_to_num(self.low - x), np.nan_to_num(x - self.high)
        from_range = self._at_least(np.maximum(np.maximum(below, above), 0.0) ** 2, known)
        to_pivot = (x - self.pivots) ** 2
        from_ball = np.maximum(np.sqrt(self._at_least(to_pivot, known)) - self.radius, 0.0) ** 2
        reach = np.sqrt(np.where(usable, to_pivot, 0.0).sum(1)) + self.radius
        farthest = np.where(usable, np.maximum(np.abs(below), np.abs(above)) ** 2, 0.0).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(n_most > 0, np.maximum(from_range, from_ball) * self.width / n_most, np.inf)
            most = np.where(n_least > 0, np.minimum(reach**2, farthest) * self.width / n_least, np.inf)
        order = np.argsort(most, kind="stable")
        supply = self.present[order][:, ~known].cumsum(0)
        enough = supply >= k
        first = np.where(enough.any(0), enough.argmax(0), -1)
        bound = np.inf if (first < 0).any() else most[order[first]].max()
        chosen = order[(n_most[order] > 0) & (least[order] * (1 - ROUNDING) <= bound * (1 + ROUNDING))]
        return chosen, least[chosen]


def _pack(layout: Layout, counts: dict[int, int], rows: int) -> tuple[list[int], list[int]]:
    """First query group of each home cell, and over how many groups the cell's queries are spread.

    Cells next to each other along the pivots' main direction share a group until it is full.
    """
    centred = layout.pivots - layout.pivots.mean(0)
    along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0]
    first, spread = [0] * len(along), [1] * len(along)
    group, filled = 0, 0
    for cell in np.argsort(along, kind="stable"):
        n = counts.get(int(cell), 0)
        if filled and filled + n > rows:
            group, filled = group + 1, 0
        first[cell], spread[cell] = group, max(1, -(-n // rows))
        group, filled = group + spread[cell] - 1, filled + n // spread[cell]
    return first, spread


def _tiles(known: np.ndarray, rows: int) -> tuple[list[np.ndarray], bool]:
    """Row numbers cut to tiles; with few patterns of gaps, every tile is of one pattern."""
    patterns, of = np.unique(np.packbits(known, axis=1), axis=0, return_inverse=True)
    alike = len(patterns) * ALIKE_ROWS <= max(len(known), ALIKE_ROWS)
    order = np.argsort(of.ravel(), kind="stable") if alike else np.arange(len(known))
    ends = np.cumsum(np.bincount(of.ravel())) if alike else np.array([len(known)])
    return [order[at : min(at + rows, end)] for begin, end in zip(np.append(0, ends[:-1]), ends) for at in range(begin, end, rows)], alike


class _Side:
    """A tile of rows around the common centre, in the number type of the products; gaps are zeros."""

    def __init__(self, at: np.ndarray, x: np.ndarray, known: np.ndarray, kind: type):
        self.at, self.known, self.x = at, known[at], np.where(known[at], x[at], 0.0).astype(kind)
        self.squares = (self.x**2).sum(1)


def _lower(q: _Side, d: _Side, alike: bool, eps: float) -> np.ndarray | None:
    """Lower bounds of all square distances between two tiles, by one product; infinite without a common coordinate.

    They lie below by at most ``2 * eps`` times the scaled sum of both rows' squares.
    """
    kind, width = q.x.dtype.type, q.x.shape[1]
    if alike:
        both = q.known[0] & d.known[0]
        if not both.any():
            return None
        a, b = q.x[:, both], d.x[:, both]
        ones = np.ones((len(a), 1), kind), np.ones((len(b), 1), kind)
        scale, less = kind(width / both.sum()), kind(1 - eps)
        a = np.concatenate([a * (-2 * scale), (a**2).sum(1)[:, None] * (less * scale), ones[0]], axis=1)
        return a @ np.concatenate([b, ones[1], (b**2).sum(1)[:, None] * (less * scale)], axis=1).T
    q_mask, d_mask = q.known.astype(kind), d.known.astype(kind)
    sums = np.concatenate([q.x**2, q_mask, -2 * q.x], axis=1) @ np.concatenate([d_mask * kind(1 - eps), d.x**2 * kind(1 - eps), d.x], axis=1).T
    common = q_mask @ d_mask.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(common > 0, sums * (width / common), np.inf).astype(kind)


def _first_bounds(lower: np.ndarray, q: _Side, d: _Side, targets: np.ndarray, alike: bool, eps: float, k: int) -> np.ndarray:
    """For every query and target a distance within which ``k`` of these donors have it, or infinity."""
    bound = np.where(targets >= 0, np.inf, -np.inf)
    width = q.x.shape[1]
    if alike and len(d.at) >= k and d.known[0][targets[0][targets[0] >= 0]].all():
        scale = width / (q.known[0] & d.known[0]).sum()
        near = np.partition(lower, k - 1, axis=1)[:, k - 1] + 2 * eps * (q.squares + d.squares.max()) * scale
        return np.where(targets >= 0, near[:, None], -np.inf)
    for i in range(len(q.at)):
        mine = targets[i][targets[i] >= 0]
        common = np.maximum((d.known & q.known[i]).sum(1), 1)
        upper = lower[i] + 2 * eps * (q.squares[i] + d.squares) * width / common
        nearest = np.argsort(upper, kind="stable")
        enough = d.known[nearest][:, mine].cumsum(0) >= k
        bound[i, : len(mine)] = np.where(enough.any(0), upper[nearest[enough.argmax(0)]], np.inf)
    return bound


def _local_top(queries: np.ndarray, donors: np.ndarray, keys: np.ndarray, k: int, within: np.ndarray | None = None):
    """Query index, target, donor index and squared distance of the k best donors in this block, as arrays.

    Products bound the distances of a tile of pairs from below; only pairs within the k-th distance met so far, at first ``within``, are compared exactly.
    """
    d_known, q_known = ~np.isnan(donors), ~np.isnan(queries)
    width = donors.shape[1]
    centre = np.where(d_known, donors, 0.0).sum(0) / np.maximum(d_known.sum(0), 1)
    key_rank = np.empty(len(keys), dtype=np.int64)
    key_rank[np.argsort(keys, kind="stable")] = np.arange(len(keys))
    around = donors - centre, queries - centre
    largest = max((np.abs(a[~np.isnan(a)]).max(initial=0.0) for a in around), default=0.0)
    kind = np.float32 if largest < 1e15 and (largest > 1e-15 or largest == 0) else np.float64
    eps = 4 * (3 * width + 8) * float(np.finfo(kind).eps)
    (d_tiles, d_alike), (q_tiles, q_alike) = _tiles(d_known, TILE[1]), _tiles(q_known, TILE[0])
    alike = d_alike and q_alike
    sides = [_Side(at, around[0], d_known, kind) for at in d_tiles]
    found = []
    for at in q_tiles:
        q = _Side(at, around[1], q_known, kind)
        gaps = ~q.known
        targets = np.full((len(at), max(gaps.sum(1).max(), 1)), -1)
        row, target = np.nonzero(gaps)
        targets[row, (gaps.cumsum(1) - 1)[row, target]] = target
        limit = np.full(len(at), np.inf) if within is None else within[at]
        bound = np.where(targets >= 0, limit[:, None], -np.inf)
        asked, donor, distance = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        wanted = gaps.any(0)
        kept = np.zeros((0, targets.shape[1]), dtype=bool)
        for d in sorted(sides, key=lambda side: -int(side.known[0][wanted].sum())) if alike else sides:
            lower = _lower(q, d, alike, eps)
            if lower is None:
                continue
            if np.isinf(bound[targets >= 0]).any():
                bound = np.minimum(bound, _first_bounds(lower, q, d, targets, alike, eps, k))
            reach = np.where(np.isinf(bound), -np.inf, bound).max(1) * (1 + 1e-6)
            hits = lower <= reach[:, None].astype(kind) * kind(1 + 1e-6)
            open_row, open_at = np.nonzero(np.isposinf(bound))
            if len(open_row):  # targets with fewer than k donors so far: whoever has them
                wants = np.zeros(q.known.shape, dtype=np.float32)
                wants[open_row, targets[open_row, open_at]] = 1
                hits |= (wants @ d.known.astype(np.float32).T > 0) & np.isfinite(lower)
            a, b = np.divmod(np.flatnonzero(hits), hits.shape[1])
            if not len(a):
                continue
            b = d.at[b]
            exact = np.concatenate([_exact(queries[at[a[i : i + PAIRS]]], donors[b[i : i + PAIRS]]) for i in range(0, len(a), PAIRS)])
            asked, donor, distance = np.append(asked, a), np.append(donor, b), np.append(distance, exact)
            order = np.lexsort((key_rank[donor], distance, asked))
            asked, donor, distance = asked[order], donor[order], distance[order]
            has = d_known[donor[:, None], targets[asked]] & (targets[asked] >= 0)
            count = has.cumsum(0)
            begins = np.searchsorted(asked, asked)
            nth = count - (count[begins] - has[begins])
            full = has & (nth == k)
            pair, column = np.nonzero(full)
            bound[asked[pair], column] = np.minimum(bound[asked[pair], column], distance[pair])
            kept = has & (nth <= k)
            some = kept.any(1)
            asked, donor, distance, kept = asked[some], donor[some], distance[some], kept[some]
        pair, column = np.nonzero(kept)
        found.append((at[asked[pair]], targets[asked[pair], column], donor[pair], distance[pair]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def _exact(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    gap = q - d
    both = ~np.isnan(gap)
    return (np.where(both, gap, 0.0) ** 2).sum(1) * (q.shape[1] / both.sum(1))


def _summary(donors: DataFrame, width: int, n_rows: int, means: list[float], key: str, array: str, block_rows: int, max_cells: int):
    n_cells = min(max_cells, max(1, SUMMARY_VALUES // width), max(1, -(-n_rows // block_rows)))
    picked = donors.orderBy(F.xxhash64(key), key).limit(n_cells).select(cols.fill(F.col(array), means).alias("x"))
    pivots = np.array([r["x"] for r in picked.collect()], dtype=float).reshape(-1, width)
    return Layout(pivots, np.array(means, dtype=float))


def neighbor_means(queries: DataFrame, donors: DataFrame, key: str = "row_key", array: str = "sensors", k: int = 5,
                   stats: list | None = None, block_rows: int | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """``(key, position, value)`` for every missing position of ``queries`` that has at least one usable donor.

    ``donors`` and ``queries`` are read several times; pass stored or checkpointed frames. ``stats`` are the
    collected ``position_stats`` of the donors, where the caller has them.
    """
    spark = donors.sparkSession
    ship_package(spark)
    key_type = donors.schema[key].dataType
    if stats is None:
        stats = cols.position_stats(donors, array).orderBy("position").collect()
    empty = spark.createDataFrame([], T.StructType([T.StructField("key", key_type), T.StructField("position", T.IntegerType()), T.StructField("value", T.DoubleType())]))
    if not stats:
        return empty
    width = len(stats)
    means = [r["mean"] if r["mean"] is not None else 0.0 for r in stats]
    part_rows = block_rows or int(np.clip(PART_BYTES // (8 * width), *PART_ROWS))
    rows = block_rows or -(-part_rows // PART_CELLS)
    donors = donors.select(F.col(key).alias("donor"), F.col(array).alias("x"))
    queries = queries.select(F.col(key).alias("key"), F.col(array).alias("x"))
    layout = _summary(donors.withColumnRenamed("donor", "key"), width, stats[0]["rows"], means, "key", "x", rows, max_cells)

    shared = spark.sparkContext.broadcast(layout)

    def assigned(batches):
        for batch in batches:
            cell, distance = shared.value.assign(_matrix(batch.column("x"), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("donor"), batch.column("x"), pa.array(cell, pa.int32()), pa.array(distance)],
                names=["donor", "x", "cell", "distance"],
            )

    donor_schema = T.StructType([T.StructField("donor", key_type), T.StructField("x", T.ArrayType(T.DoubleType())),
                                 T.StructField("cell", T.IntegerType()), T.StructField("distance", T.DoubleType())])
    placed = stored(donors.mapInArrow(assigned, donor_schema))
    n_missing = F.aggregate("x", F.lit(0), lambda n, v: n + v.isNull().cast("int"))
    per_cell = {
        r["cell"]: (r["n"], r["radius"], r["missing"])
        for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.max(n_missing).alias("missing")).collect()
    }
    ranges = (
        placed.select("cell", F.posexplode("x").alias("position", "value"))
        .groupBy("cell", "position")
        .agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .where("n > 0")
        .toPandas()
    )
    layout.summarise(per_cell, ranges)
    bounds = spark.sparkContext.broadcast(layout)

    def routed(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            home, _ = bounds.value.assign(x)
            visits = [bounds.value.visits(q, k) for q in x]
            cells = pa.array([v[0].astype(np.int32) for v in visits], pa.list_(pa.int32()))
            least = pa.array([v[1] for v in visits], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("x"), pa.array(home, pa.int32()), cells, least],
                names=["key", "x", "home", "cells", "least"],
            )

    query_schema = T.StructType([T.StructField("key", key_type), T.StructField("x", T.ArrayType(T.DoubleType())),
                                 T.StructField("home", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType())),
                                 T.StructField("least", T.ArrayType(T.DoubleType()))])
    routes = stored(queries.mapInArrow(routed, query_schema))
    per_home = {r["home"]: r["n"] for r in routes.groupBy("home").agg(F.count("*").alias("n")).collect()}
    if not per_home:
        return empty
    group_rows = block_rows or int(np.clip(-(-sum(per_home.values()) // (4 * spark.sparkContext.defaultParallelism)), *GROUP_ROWS))
    (begins, held), (first, spread) = (tuple(map(constants.ints, _pack(layout, counts, n))) for counts, n in (
        ({c: int(n) for c, n in enumerate(layout.count)}, part_rows), (per_home, group_rows)))

    def salt(column: str, of: Column, cell: str) -> Column:
        return F.pmod(F.xxhash64(column, F.lit(17)), F.get(of, F.col(cell))).cast("int")

    def parts_of(cells: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(cells, lambda c: F.sequence(F.get(begins, c), F.get(begins, c) + F.get(held, c) - 1))))

    grouped = routes.withColumn("group", F.get(first, F.col("home")) + salt("key", spread, "home"))
    in_parts = placed.select("donor", "x", (F.get(begins, F.col("cell")) + salt("donor", held, "cell")).alias("part"))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        donor_keys = right.column("donor").to_numpy()
        d, q = _matrix(right.column("x"), width), _matrix(left.column("x"), width)
        if len(d) and len(q):
            asked_by, target, donor, distance = _local_top(q, d, donor_keys, k, left.column("within").to_numpy())
        else:
            asked_by, target, donor, distance = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return pa.table({
            "key": left.column("key").take(pa.array(asked_by)),
            "position": pa.array(target, pa.int32()),
            "donor": right.column("donor").take(pa.array(donor)),
            "distance": pa.array(distance),
            "donated": pa.array(d[donor, target]),
        })

    top_schema = T.StructType([T.StructField("key", key_type), T.StructField("position", T.IntegerType()), T.StructField("donor", key_type),
                               T.StructField("distance", T.DoubleType()), T.StructField("donated", T.DoubleType())])

    def search(asking: DataFrame) -> DataFrame:
        """Local top-k of every (part, group) for queries with the ``parts`` to visit and the distance ``within`` which to look."""
        sent = asking.select("key", "x", "within", "group", F.explode("parts").alias("part"))
        pairs = asking.select(F.col("group").alias("asker"), F.explode("parts").alias("part")).distinct()
        offered = in_parts.join(F.broadcast(pairs), "part")  # a row for every part and group: copies are made where the donors are read
        return sent.groupBy("part", "group").cogroup(offered.groupBy("part", "asker")).applyInArrow(best, top_schema)

    nearest_first = Window.partitionBy("key", "position").orderBy("distance", "donor")
    anywhere = F.lit(float("inf"))
    grouped = grouped.withColumn("home_parts", parts_of(F.slice("cells", 1, 1)))
    local = search(grouped.withColumn("parts", F.col("home_parts")).withColumn("within", anywhere))
    if len(layout.count) > 1:
        local = stored(local)
        reached = (
            local.repartition("key")
            .withColumn("rank", F.row_number().over(nearest_first))
            .where(F.col("rank") == k)
            .groupBy("key")
            .agg(F.count("*").alias("n_full"), F.max("distance").alias("reach"))
        )
        within = F.when(F.col("n_full") == n_missing, F.col("reach")).otherwise(anywhere)
        others = F.filter(
            F.slice(F.arrays_zip("cells", "least"), 2, len(layout.count)),
            lambda c: c["least"] * (1 - ROUNDING) <= F.col("within") * (1 + ROUNDING),
        )
        rest = grouped.join(reached, "key", "left").withColumn("within", within)
        rest = rest.withColumn("parts", F.array_except(parts_of(F.transform(others, lambda c: c["cells"])), "home_parts"))
        local = local.unionByName(search(stored(rest.where(F.size("parts") > 0).select("key", "x", "within", "group", "parts"))))
    return (
        # Partitioned on the key alone, so that ranking, averaging and a later join on the key share one shuffle.
        local.repartition("key")
        .withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .groupBy("key", "position")
        .agg(F.avg("donated").alias("value"))
    )


def knn_impute(df: DataFrame, key: str = "row_key", array: str = "sensors", k: int = 5, donors: DataFrame | None = None,
               **layout) -> DataFrame:
    """Fill the NULL elements of ``array``; a position without any usable donor takes its mean.

    ``key`` must be unique. Complete rows pass through untouched and unshuffled.
    """
    source = df if donors is None else donors
    incomplete = F.exists(array, lambda v: v.isNull())
    gaps = df.where(incomplete)
    stats = cols.position_stats(source, array).orderBy("position").collect()
    means = [r["mean"] for r in stats]
    values = neighbor_means(gaps, source, key, array, k, stats, **layout)
    per_row = values.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("position", "value"))).alias("_found"))
    found = F.transform(array, lambda v, i: F.coalesce(v, F.try_element_at("_found", i)))
    filled = (
        gaps.join(per_row.withColumnRenamed("key", key), key, "left")
        .withColumn(array, cols.fill(found, means))
        .select(*df.columns)
    )
    return df.where(~incomplete).unionByName(filled)


def knn_vote(queries: DataFrame, donors: DataFrame, label: str = "label", key: str = "row_key", array: str = "sensors",
             k: int = 5, score: str = "probability", **layout) -> DataFrame:
    """Share of label 1 among the ``k`` nearest donors, added to ``queries`` as ``score``.

    The label is one more coordinate that donors have and queries lack, so the same search fills it.
    """
    known = donors.select(key, F.concat(array, F.array(F.col(label).cast("double"))).alias("x"))
    asked = queries.select(key, F.concat(array, F.array(F.lit(None).cast("double"))).alias("x"))
    votes = neighbor_means(asked, known, key, "x", k, **layout)
    width = F.size(array)
    # A query may have other missing coordinates too; only the label's position is a vote.
    share = votes.withColumnRenamed("key", key).select(key, "position", F.col("value").alias(score))
    joined = queries.withColumn("_label_at", width).join(share.withColumnRenamed("position", "_label_at"), [key, "_label_at"], "left")
    return joined.drop("_label_at")

"""Near duplicates by SimHash: fingerprints, and BK-trees over shards of them.

Fingerprints at most ``RADIUS`` bits apart agree in two of four 16-bit blocks, so each distinct fingerprint joins six
shards, one per pair of blocks. A shard's fingerprints meet in one task as one array; there a BK-tree (children keyed by their
Hamming distance to the parent) takes them one by one, follows only edges within the radius of what it looks for, and yields a
spanning forest of links, never all pairs. Trees travel to their queries by this shuffle and not by a broadcast, whose size would
grow with the corpus; at 10^10 documents a shard holds two or three fingerprints.

A shard over ``SHARD_LIMIT`` fingerprints, which only a very large group of near copies makes, is taken apart exactly in another way: two
fingerprints are within two bits if and only if some point is within one bit of both. Each of its fingerprints names its 65 points, and
those that share a point (65 at most) are linked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from faultline.llm.components import connected
from faultline.llm.tables import fresh_name, numbered
from faultline.session import TEXT_BYTES, ship_package, stored

RADIUS = 2
SHINGLE = 3
BLOCKS = 4
SHARD_LIMIT = 512
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text: bits set in over half of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    runs = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(runs), HASHES_AT_ONCE):
        some = runs[at : at + HASHES_AT_ONCE]
        hashes = np.fromiter((xxhash.xxh64_intdigest(run, 42) for run in some), dtype=">u8", count=len(some))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(runs)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(text.as_buffer().to_pybytes() if text.is_valid else b"") for text in batch.column("text")), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_id"), pa.array(found.view(np.int64))], ["doc_id", "row_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, row_id and the fingerprint as a signed long, one row per document."""
    ship_package(docs.sparkSession)
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id bigint, row_id bigint, fp bigint")


class BkTree:
    """A BK-tree of 64-bit numbers under Hamming distance."""

    def __init__(self, root: int):
        self.root = root
        self.children: dict[int, dict[int, int]] = {root: {}}

    def add(self, value: int) -> None:
        node = self.root
        while node != value:
            distance = (node ^ value).bit_count()
            below = self.children[node].get(distance)
            if below is None:
                self.children[node][distance] = value
                self.children[value] = {}
                return
            node = below

    def within(self, value: int, radius: int) -> list[int]:
        found, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            if children:
                waiting += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]
        return found


def forest(values: Iterable[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links within the radius that connect what all such links connect: at most one less than there are values."""
    tree: BkTree | None = None
    over: dict[int, int] = {}

    def top(x: int) -> int:
        while over[x] != x:
            over[x] = x = over[over[x]]
        return x

    links = []
    for value in values:
        if value in over:
            continue
        over[value] = value
        if tree is None:
            tree = BkTree(value)
            continue
        for near in tree.within(value, radius):
            a, b = top(value), top(near)
            if a != b:
                over[a] = b
                links.append((value, near))
        tree.add(value)
    return links


def _tree_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = [link for shard in batch.column("fps").to_pylist() for link in forest(np.array(shard, dtype=np.int64).view(np.uint64).tolist())]
        ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def links(fps: DataFrame, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links a, b among distinct fingerprints ``fp`` that connect all that are within the radius."""
    ship_package(fps.sparkSession)
    width = 64 // BLOCKS
    blocks = [F.shiftrightunsigned("fp", width * i).bitwiseAND((1 << width) - 1) for i in range(BLOCKS)]
    pairs = combinations(range(BLOCKS), BLOCKS - RADIUS)
    shards = [F.struct(F.lit(n).alias("pair"), F.shiftleft(blocks[i], width).bitwiseOR(blocks[j]).alias("part")) for n, (i, j) in enumerate(pairs)]
    sharded = fps.select("fp", F.explode(F.array(*shards)).alias("shard")).select("fp", "shard.pair", "shard.part")
    hot = stored(sharded.groupBy("pair", "part").count().filter(F.col("count") > shard_limit).select("pair", "part"))
    trees = sharded.join(hot, ["pair", "part"], "left_anti").groupBy("pair", "part").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    by_tree = trees.select("fps").mapInArrow(_tree_links, "a bigint, b bigint")

    crowded = sharded.join(hot, ["pair", "part"], "left_semi").select("fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR((1 << k) - (1 << 64 if k == 63 else 0)) for k in range(64)])
    meeting = crowded.select("fp", F.explode(around).alias("point")).groupBy("point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    by_point = meeting.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a != b")
    return by_tree.union(by_point)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id, kept, row_id.

    Texts whose fingerprints can be reached over links of at most two bits are one component, named by its smallest doc_id (null if
    it has none); its row is ``kept``, of repeated rows one. A null or wordless text has fingerprint zero and is linked like any other. An
    empty table gives no rows; other columns are ignored. ``row_col``: a unique row number, if the caller needs it back.
    """
    rows = stored(fingerprints(docs, id_col, text_col, row_col), TEXT_BYTES)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("first")
    distinct = stored(rows.groupBy("fp").agg(first))
    roots = connected(links(distinct.select("fp"), shard_limit))
    linked = distinct.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"))
    linked = linked.join(lowest, "root").select("fp", "lowest")
    named = distinct.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("lowest"))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("lowest.doc_id").alias("component_id"),
        (F.col("row_id") == F.col("lowest.row_id")).alias("kept"), "row_id",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each component, all columns."""
    row = fresh_name(docs, "row")
    rows = numbered(docs, row)
    gone = stored(near_duplicates(rows, id_col, text_col, row_col=row).filter("not kept").select(F.col("row_id").alias(row)))  # its size decides how it is joined
    return rows.join(gone, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])

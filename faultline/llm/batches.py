"""Batches of documents that meet by hashes: the frame of both substring operators.

Documents are dealt to batches of about ``DOCS_PER_BATCH``. A batch names each of its hash values once, packed in one row per part of the
hash range, and gets an answer from that part. So a passage that a third of all documents hold reaches a part once per batch, not
once per document, and the exchange carries packed numbers instead of rows. Every step works on the batches of one and the same
exchange, which Spark reuses: texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DOCS_PER_BATCH = 256
BYTES_PER_PART = 16 << 20


def batched(docs: DataFrame, id_col: str, text_col: str, docs_per_batch: int = DOCS_PER_BATCH) -> tuple[DataFrame, int]:
    """batch, doc_id and text (null: empty), and how many parts the hash range should have."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length(F.col(text_col)))).first()
    batch = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(-(-rows // docs_per_batch) or 1))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // BYTES_PER_PART))
    return docs.select(batch.alias("batch"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), parts


def in_order(table: pa.Table) -> pa.Table:
    """A batch's rows in an order that does not depend on their arrival, so that a row's place names it in every step."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def texts_of(table: pa.Table) -> list[bytes]:
    """The texts as UTF-8."""
    return [text.as_buffer().to_pybytes() for chunk in table.column("text").chunks for text in chunk]


def mixed_bits(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every bit of the outcome depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def part_of(values: np.ndarray, parts: int) -> np.ndarray:
    """A part for each value, from bits that are mixed anew, so that values in a part still differ in all their bits."""
    return (mixed_bits(values + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def rows_by_part(batch: int, parts: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per part that has values: the batch, the part, and each column packed."""
    order = np.argsort(parts, kind="stable")
    found, begins = np.unique(parts[order], return_index=True)
    ends = np.append(begins[1:], len(order))
    packed = {name: [column[order[b:e]].tobytes() for b, e in zip(begins, ends)] for name, column in columns.items()}
    arrays = [pa.array([batch] * len(found), pa.int64()), pa.array(found.astype(np.int64)), *[pa.array(p, pa.binary()) for p in packed.values()]]
    return pa.Table.from_arrays(arrays, ["batch", "part", *packed])


def unpacked(table: pa.Table, column: str, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """A packed column of all rows as one array, and the number of values in each row."""
    rows = [np.frombuffer(value.as_buffer(), dtype=dtype) if value.is_valid else np.empty(0, dtype) for value in table.column(column)]
    return np.concatenate(rows) if rows else np.empty(0, dtype), np.array([len(r) for r in rows], dtype=np.int64)


def answers(table: pa.Table, columns: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """One row per row of ``table``: its batch, and what is picked for it. ``columns``: the values and, for each, its row."""
    picked = {}
    for name, (values, rows) in columns.items():
        edges = np.searchsorted(rows, np.arange(table.num_rows + 1))
        picked[name] = [values[edges[i] : edges[i + 1]].tobytes() for i in range(table.num_rows)]
    first = next(iter(picked.values()))
    keep = [i for i, value in enumerate(first) if value]
    arrays = [table.column("batch").take(pa.array(keep, pa.int64())).combine_chunks(), *[pa.array([v[i] for i in keep], pa.binary()) for v in picked.values()]]
    return pa.Table.from_arrays(arrays, ["batch", *picked])


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and for each value its run."""
    fresh = np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, dtype=bool)
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``width`` that begins at a marked start."""
    edges = np.zeros(length + 1, dtype=np.int32)
    edges[:-width][starts] += 1
    edges[width:][starts] -= 1
    return np.cumsum(edges[:-1]) > 0


def by_batch(left: DataFrame, right: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return left.groupBy("batch").cogroup(right.groupBy("batch")).applyInArrow(work, schema)


"""Substring dedup on words with fixed-block anchors.

Any 13 consecutive words hold a whole block of 7 that begins at a multiple of 7 of the text they are taken from. So the non-overlapping
7-word blocks of all texts are the index, and every rolling 7-word window of all texts probes it. Around the hits, in the text that owns the
block and in the one that probes it, the 13-word windows are the candidates; they meet in a second exchange, which finds the smallest
document of each, and consecutive ones are the maximal exact repeats, which are cut from all later documents.

Hashes of the probes have 31 bits besides those that pick their part and may raise a false candidate; windows are
compared by 64 bits besides those of their part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from faultline.llm.batches import answers, batched, by_batch, covered, mixed_bits, part_of, rows_by_part, runs, texts_of, unpacked
from faultline.session import ship_package

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
NO_ID = np.iinfo(np.int64).max  # a null id counts as the largest
_FACTOR = 0x5851F42D4C957F2D


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total = total * np.uint64(_FACTOR) + hashes[i : i + n]
    return mixed_bits(total)


class Batch:
    """A batch's texts as words, with the hashes of all their windows of a width, one after the other."""

    def __init__(self, table: pa.Table):
        self.words = [text.split() for text in texts_of(table)]
        self.hashes = [word_hashes(words) for words in self.words]
        self.ids = table.column("doc_id").to_pylist()
        self.order = np.array([NO_ID if i is None else i for i in self.ids], dtype=np.int64)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document and place of each window."""
        found = [rolling(h, width) for h in self.hashes]
        sizes = [len(f) for f in found]
        docs = np.repeat(np.arange(len(found)), sizes)
        places = np.concatenate([np.arange(n) for n in sizes]) if found else np.empty(0, dtype=np.int64)
        return np.concatenate(found) if found else np.empty(0, dtype=np.uint64), docs, places


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(values)
    begins, run = runs(values[order])
    return order, begins, run


def _short(values: np.ndarray) -> np.ndarray:
    """31 bits of a probe's hash, with the lowest bit free."""
    return (values & np.uint64(0xFFFFFFFE)).astype(np.uint32)


def removable(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of 13 words that covers it also starts in a document with a smaller id; windows are judged on the input. A null
    text is empty and a null id the largest, so that two of those take nothing from each other, nor do repeated rows of one id. Texts of under 13
    words stay whole; other columns are ignored; no rows give no rows.
    """
    ship_package(docs.sparkSession)
    batches, parts = batched(docs, id_col, text_col)

    def probe(table: pa.Table) -> pa.Table:
        values, _, places = Batch(table).windows(BLOCK)
        order, begins, _ = _grouped(values)
        indexed = np.maximum.reduceat((places[order] % BLOCK == 0).astype(np.uint32), begins) if len(begins) else np.empty(0, dtype=np.uint32)
        distinct = values[order][begins]
        return rows_by_part(_batch(table), part_of(distinct, parts), {"hits": _short(distinct) | indexed})

    def meet(table: pa.Table) -> pa.Table:
        values, sizes = unpacked(table, "hits", "<u4")
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(values)
        begins, run = runs(values[order] >> np.uint32(1))
        several = np.diff(np.append(begins, len(values))) > 1
        indexed = np.maximum.reduceat(values[order] & np.uint32(1), begins) > 0 if len(begins) else several
        live = np.sort(order[(several & indexed)[run]])
        return answers(table, {"live": ((values[live] >> np.uint32(1)).astype("<u4"), rows[live]), "parts": (np.full(len(live), table.column("part")[0].as_py(), dtype="<u4"), rows[live])})

    def extend(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _EMPTY_WINDOWS
        batch = Batch(table)
        values, owners, places = batch.windows(BLOCK)
        order, begins, run = _grouped(values)
        live = np.zeros(len(values), dtype=bool)
        if len(values):
            low, high = (f.reduceat(batch.order[owners[order]], begins) for f in (np.minimum, np.maximum))
            indexed = np.maximum.reduceat(places[order] % BLOCK == 0, begins)
            live[order] = ((low < high) & indexed)[run]
            short, part = unpacked(found, "live", "<u4")[0].astype(np.uint64), unpacked(found, "parts", "<u4")[0].astype(np.uint64)
            live |= np.isin(part_of(values, parts) << np.uint64(31) | (_short(values) >> np.uint32(1)).astype(np.uint64), part << np.uint64(31) | short)
        windows, holders, starts = batch.windows(WINDOW)
        lengths = np.array([len(w) for w in batch.words], dtype=np.int64)
        first_block = np.concatenate([[0], np.cumsum(np.maximum(lengths - BLOCK + 1, 0))])
        before = np.concatenate([[0], np.cumsum(live)])
        at = first_block[holders] + starts
        candidate = before[at + WINDOW - BLOCK + 1] > before[at] if len(at) else np.empty(0, dtype=bool)
        windows, holders = windows[candidate], holders[candidate]
        order, begins, _ = _grouped(windows)
        smallest = np.minimum.reduceat(batch.order[holders[order]], begins) if len(begins) else np.empty(0, dtype=np.int64)
        distinct = windows[order][begins]
        return rows_by_part(_batch(table), part_of(distinct, parts), {"windows": distinct, "smallest": smallest})

    def earliest(table: pa.Table) -> pa.Table:
        values, sizes = unpacked(table, "windows", "<u8")
        smallest, _ = unpacked(table, "smallest", "<i8")
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order, begins, run = _grouped(values)
        least = np.minimum.reduceat(smallest[order], begins)[run] if len(begins) else smallest
        overall = np.empty_like(smallest)
        overall[order] = least
        told = np.flatnonzero(overall < smallest)
        return answers(table, {"windows": (values[told], rows[told]), "smallest": (overall[told], rows[told])})

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        batch = Batch(table)
        values, owners, places = batch.windows(WINDOW)
        gone = np.zeros(len(values), dtype=bool)
        if len(values):
            order, begins, run = _grouped(values)
            distinct, least = values[order][begins], np.minimum.reduceat(batch.order[owners[order]], begins)
            told, smallest = unpacked(found, "windows", "<u8")[0], unpacked(found, "smallest", "<i8")[0]
            np.minimum.at(least, np.searchsorted(distinct, told), smallest)
            gone[order] = least[run] < batch.order[owners[order]]
        rows, at = [], 0
        for doc_id, words in zip(batch.ids, batch.words):
            n = max(len(words) - WINDOW + 1, 0)
            own, at = gone[at : at + n], at + n
            kept = words
            if own.any():
                kept = [w for w, out in zip(words, covered(own, WINDOW, len(words))) if not out]
            rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    hits = batches.groupBy("batch").applyInArrow(probe, "batch bigint, part bigint, hits binary")
    live = hits.groupBy("part").applyInArrow(meet, "batch bigint, live binary, parts binary")
    windows = by_batch(batches, live, extend, "batch bigint, part bigint, windows binary, smallest binary")
    told = windows.groupBy("part").applyInArrow(earliest, "batch bigint, windows binary, smallest binary")
    return by_batch(batches, told, cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


_EMPTY_WINDOWS = pa.Table.from_pylist([], pa.schema([("batch", pa.int64()), ("part", pa.int64()), ("windows", pa.binary()), ("smallest", pa.binary())]))


def _batch(table: pa.Table) -> int:
    return table.column("batch")[0].as_py()

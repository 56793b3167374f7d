"""Packing token sequences by minimum bin slack.

A document's ids are cut in full windows and one rest. The rests' lengths, a table of at most ``capacity`` counts however
large the corpus, decide all: the longest length that is left opens a window, a subset-sum program over bitsets finds the
multiset of lengths that fills it closest to capacity, and that pattern is repeated as often as the counts allow, so every
step uses up a length. Pieces then find their windows by their rank among pieces of equal length: they are sorted by length
over range partitions, and what a partition adds to a rank is one number per partition and length.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultline.session import TEXT_BYTES, ship_package, stored

CAPACITY = 1024
END = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The part of the splitting pattern that leaves the last of several white-space characters to the next word.
LOOK_AHEAD = r"\s+(?!\S)|"
ROWS_AT_ONCE = 4096
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"


class ByteBpe:
    """Ids of a byte-level BPE vocabulary given as ranks: ``ids`` takes special tokens' strings as ordinary text, ``ids_with_special`` as tokens.

    The same vocabulary and ids as the JSON form in the ``tokenizers`` library. The splitting pattern looks ahead only to part a run of white
    space; a text without such runs is split alike, and much faster, by the pattern without that.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import os

        import public_tokenizers
        import regex
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        added = os.path.join(os.path.dirname(public_tokenizers.path(vocabulary)), os.path.splitext(vocabulary)[0] + ".json")
        self.special: dict[str, int] = {}
        if os.path.exists(added):
            with open(added, encoding="utf-8") as form:
                self.special = {token["content"]: token["id"] for token in json.load(form)["added_tokens"]}
        self.whole = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        named = lambda pattern: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.encode, self.encode_plain = named(public_tokenizers.PATTERN), named(public_tokenizers.PATTERN.replace(LOOK_AHEAD, ""))
        self.has_run = regex.compile(r"\s\s").search

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(array("I", (self.encode if self.has_run(text) else self.encode_plain)(text)), dtype=np.uint32)

    def ids_with_special(self, text: str) -> np.ndarray:
        """What the library's default gives: an added token's string is that token wherever it stands."""
        if not any(token in text for token in self.special):
            return self.ids(text)
        return np.array(self.whole.encode(text, allowed_special="all"), dtype=np.uint32)


@lru_cache(maxsize=1)
def tokenizer(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int]]:
    """Start, length and checksum of each full window and of the rest."""
    for start in range(0, len(ids), capacity):
        piece = ids[start : start + capacity]
        yield start, len(piece), zlib.crc32(piece.astype("<u4", copy=False).tobytes())


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens; each document ends with id 0."""
    ship_package(docs.sparkSession)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kinds = tokenizer(vocabulary), [pa.int64()] * 5
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encoder.ids_with_special(text.as_py() or ""), np.uint32(END))
                rows += [(doc_id, *piece, len(ids)) for piece in cut(ids, capacity)]
                if len(rows) >= ROWS_AT_ONCE:
                    yield _batch(rows, kinds)
                    rows = []
            yield _batch(rows, kinds)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tokenize, PIECES)


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)


def fullest(counts: dict[int, int], first: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths, with ``first`` in it, whose sum is closest to the capacity; lengths to how many."""
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # a length, how many at once, and the sums that were reachable before
    reach = 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), room // length)
        at_once = 1
        while left > 0:
            take = min(at_once, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            at_once *= 2
        if reach >> room & 1:
            break
    total, pattern = reach.bit_length() - 1, {first: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            pattern[length] = pattern.get(length, 0) + take
    return pattern


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns and how often each is used, longest first lengths first, until all lengths are used up."""
    left, found = {k: v for k, v in counts.items() if v}, []
    while left:
        pattern = fullest(left, max(left), capacity)
        times = min(left[length] // n for length, n in pattern.items())
        found.append((pattern, times))
        for length, n in pattern.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return found


def _places(found: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows of: first rank, first sequence, how many per sequence, offset of the first in a sequence."""
    used: dict[int, int] = {}
    places: dict[int, list] = {}
    sequence = 0
    for pattern, times in found:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            places.setdefault(length, []).append((used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in places.items()}


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document (a null text is empty) is its ids and one 0; each id lies in one piece and a sequence holds at most ``capacity``.
    Repeated rows and ids are separate documents, a null id stays null, and no rows give no rows. Very long texts are cut one at a time.
    """
    spark = docs.sparkSession
    rows = stored(pieces(docs, id_col, text_col, capacity, vocabulary), TEXT_BYTES)
    by_length = ["length", "spread", "doc_id", "start", "ids_crc32"]
    spread = rows.withColumn("spread", F.xxhash64("doc_id", "start"))
    ranged = spread.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by_length).sortWithinPartitions(*by_length)
    ranked = stored(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_ranked, f"{PIECES}, part int, rank bigint"))
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for part, length, n in sorted(ranked.groupBy("part", "length").count().collect()):  # a row per partition, and one per length at most
        before[part, length] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + n
    places = _places(patterns(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part, rank = (batch.column(c).to_numpy() for c in ("length", "part", "rank"))
            sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
            for key in np.unique(np.stack([part, length]), axis=1).T.tolist():
                at = np.flatnonzero((part == key[0]) & (length == key[1]))
                overall, rules = rank[at] + before[key[0], key[1]], places[key[1]]
                rule = rules[np.searchsorted(rules[:, 0], overall, side="right") - 1]
                turn = overall - rule[:, 0]
                sequence[at] = rule[:, 1] + turn // rule[:, 2]
                offset[at] = rule[:, 3] + turn % rule[:, 2] * key[1]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED)


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each length in a partition that is sorted by length."""
    last, seen = -1, 0
    for batch in batches:
        length = batch.column("length").to_numpy()
        if not len(length):
            continue
        begins = np.flatnonzero(np.concatenate([[True], length[1:] != length[:-1]]))
        rank = np.arange(len(length)) - np.repeat(begins, np.diff(np.append(begins, len(length))))
        if length[0] == last:
            rank[: begins[1] if len(begins) > 1 else len(length)] += seen
        last, seen = int(length[-1]), int(rank[-1]) + 1
        kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(rank)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"])

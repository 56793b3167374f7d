"""Raw drop-folder scans: file list, digests with headers, and numbered records.

A folder is scanned flat, so a file's name identifies it; every frame here carries it as ``file``.
"""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faultline.functions import csvcells, literals
from faultline.session import ship_package

FIELD_LIMIT = csv.field_size_limit()
RECORD_SCHEMA = "file string, chunk bigint, line_id bigint, cells array<string>, failure string"
DIGEST_SCHEMA = "file string, sha256 string, first_line binary, n_lines bigint"
ROWS_PER_BATCH = 2000
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
UNREAD = "file cannot be read whole"


def _scan(spark: SparkSession, extension: str):
    """A file that fails while it is read gives fewer lines or none, instead of ending the job; ``digests`` tells which were read whole."""
    return (
        spark.read.option("pathGlobFilter", f"*{extension}")
        .option("recursiveFileLookup", "false")
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
    )


def content_limit(spark: SparkSession) -> int:
    """Up to this size Spark's binary source reads a file as one value; larger ones are streamed in order."""
    return int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))


def filled_files(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """``(file, length)`` of every file that has any byte; none is opened."""
    return _scan(spark, extension).format("binaryFile").load(folder).select(_base_name(F.col("path")).alias("file"), "length")


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def list_files(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """``(file)`` for every file, zero-byte ones too, which scans leave out.

    The names come from the file index that Spark's driver builds for any scan of the folder.
    """
    paths = [(p,) for p in _scan(spark, extension).format("binaryFile").load(folder).inputFiles()]
    slices = max(1, len(paths) // 10_000)
    listed = spark.createDataFrame(spark.sparkContext.parallelize(paths, slices), "path string")
    return listed.select(_decoded_name(F.col("path")).alias("file"))


def _decoded_name(uri: Column) -> Column:
    return F.url_decode(F.replace(_base_name(uri), F.lit("+"), F.lit("%2B")))


def digests(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """``(file, sha256, header, n_lines)`` from the raw bytes; a byte-order mark stays part of the first header cell.

    A file that cannot be read has no row. ``n_lines`` is what ``lines`` finds in the file when it reads all of it.
    """
    limit = content_limit(spark)
    text = F.col("content").cast("string")
    first_line = F.substring_index(F.substring_index(text, "\n", 1), "\r", 1)
    found = _scan(spark, extension).format("binaryFile").load(folder).where(F.col("length") <= limit).select(
        _base_name(F.col("path")).alias("file"),
        F.sha2("content", 256).alias("sha256"),
        first_line.cast("binary").alias("first_line"),
        _line_count(text).alias("n_lines"),
    )
    large = filled_files(spark, folder, extension).where(F.col("length") > limit)
    if not large.isEmpty():
        found = found.unionByName(_in_order(spark, folder, limit, extension).mapInPandas(_digest_streams, DIGEST_SCHEMA))
    return found.select("file", "sha256", csvcells.cells(F.make_valid_utf8(F.col("first_line").cast("string"))).alias("header"), "n_lines")


def _line_count(text: Column) -> Column:
    """Lines that end in a line feed, a carriage return or both, and an open last one; a mark alone is no line."""

    def found(mark: str) -> Column:
        return F.floor((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark))

    returns = F.when(F.contains(text, F.lit("\r")), found("\r") - found("\r\n")).otherwise(F.lit(0))
    closed = F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r")) | text.isin("", BYTE_ORDER_MARK.decode())
    return (found("\n") + returns + F.when(closed, 0).otherwise(1)).cast("bigint")


def _in_order(spark: SparkSession, folder: str, limit: int, extension: str, files: DataFrame | None = None) -> DataFrame:
    """``(file, lost, piece)``: the bytes of every file larger than ``limit``, cut at line feeds, a file's pieces in order in one task.

    Spark sorts and spills the pieces, so a file of any size takes constant memory. ``lost`` is how many bytes the pieces joined by line
    feeds lack: 1 is a last line feed, 3 a byte-order mark, which the reader takes off. Any other number means that not all was read.
    """
    ship_package(spark)
    raw = _scan(spark, extension).option("lineSep", "\n").text(folder).where(F.col("_metadata.file_size") > limit).select(
        _decoded_name(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").cast("binary").alias("piece"),
    )
    if files is not None:
        raw = raw.join(files, "file", "left_semi")
    totals = raw.groupBy("file").agg((F.max("size") - F.sum(F.octet_length("piece") + 1) + 1).alias("lost"))
    return (
        raw.join(totals, "file")
        .repartition("file")
        .sortWithinPartitions("file", "chunk", "line_id")
        .select("file", "lost", "piece")
    )


def _streams(batches):
    """Per file its name and the iterator of its bytes; the iterator of a file that was not read whole is None."""
    rows = itertools.chain.from_iterable(zip(b["file"], b["lost"], b["piece"]) for b in batches)
    for (name, lost), pieces in itertools.groupby(rows, key=lambda row: row[:2]):
        yield name, _bytes_of(lost, pieces) if lost in (0, 1, 3, 4) else None


def _bytes_of(lost: int, rows):
    for i, (_, _, piece) in enumerate(rows):
        mark = BYTE_ORDER_MARK if lost >= 3 else b""
        yield b"\n" + piece if i else mark + piece
    if lost % 3 == 1:
        yield b"\n"


def _digest_streams(batches):
    """A file that was not read whole gives no row, as if it could not be opened."""
    for name, pieces in _streams(batches):
        if pieces is None:
            continue
        first = next(pieces)
        digest = hashlib.sha256(first)
        breaks, size, last = _breaks(first, b""), len(first), first[-1:]
        for piece in pieces:
            digest.update(piece)
            breaks += _breaks(piece, last)
            size, last = size + len(piece), piece[-1:]
        closed = last in (b"\n", b"\r") or (first == BYTE_ORDER_MARK and size == len(first))
        n_lines = breaks + (0 if closed else 1)
        yield pd.DataFrame([(name, digest.hexdigest(), first.split(b"\r")[0], n_lines)], columns=["file", "sha256", "first_line", "n_lines"])


def _breaks(piece: bytes, before: bytes) -> int:
    """Line ends in ``piece``; a line feed that follows a carriage return is part of its end."""
    split_pair = before == b"\r" and piece[:1] == b"\n"
    return piece.count(b"\n") + piece.count(b"\r") - piece.count(b"\r\n") - split_pair


def lines(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """``(file, chunk, line_id, line)``; blank lines are kept.

    ``chunk`` is the byte offset of the file split, and ``line_id`` counts up inside it, so a line number is
    the number of lines in earlier chunks plus the distance to the chunk's first ``line_id``. No file is ever
    gathered in one task to number its lines.
    """
    return _scan(spark, extension).text(folder).select(
        _decoded_name(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("line_id"),
        F.make_valid_utf8("value").alias("line"),
    )


def line_records(numbered: DataFrame, kinds: list[str]) -> DataFrame:
    """One record per line; ``open`` marks lines whose record continues on the next one.

    Lines that are ``plain`` for the column types ``kinds`` carry no cells: they are known to be sound.
    """
    oversized = F.exists("cells", lambda cell: F.length(cell) > FIELD_LIMIT)
    return (
        numbered.withColumn("plain", (F.length("line") <= FIELD_LIMIT) & literals.is_plain_line(F.col("line"), kinds))
        .withColumn("cells", F.when(~F.col("plain"), csvcells.cells(F.col("line"))))
        .withColumn(
            "failure",
            # Only a line above the limit can hold a cell above it.
            F.when((F.length("line") > FIELD_LIMIT) & oversized, f"field larger than field limit ({FIELD_LIMIT})"),
        )
        .withColumn("open", ~F.col("plain") & csvcells.is_open(F.col("line")))
        .withColumn("blank", ~F.col("plain") & ~F.col("line").rlike(r"[^\x00-\x20]"))
        .drop("line")
    )


class _Pieces(io.RawIOBase):
    """A readable file over an iterator of byte strings."""

    def __init__(self, pieces):
        self._pieces, self._rest = pieces, b""

    def readable(self):
        return True

    def readinto(self, buffer):
        while not self._rest:
            piece = next(self._pieces, None)
            if piece is None:
                return 0
            self._rest = piece
        part, self._rest = self._rest[:len(buffer)], self._rest[len(buffer):]
        buffer[:len(part)] = part
        return len(part)


def _records_of(name: str, source: io.IOBase):
    reader = csv.reader(io.TextIOWrapper(source, encoding="utf-8", errors="replace"))
    number = 0
    while True:
        try:
            yield name, 0, number, next(reader), None
        except StopIteration:
            return
        except csv.Error as error:
            yield name, 0, number, [], str(error)
            return
        number += 1


def _whole_contents(batches):
    for batch in batches:
        for name, content in zip(batch["file"], batch["content"]):
            yield name, io.BytesIO(content)


def _ordered_contents(batches):
    for name, pieces in _streams(batches):
        if pieces is not None:
            yield name, io.BufferedReader(_Pieces(pieces))


def _read_spanning(batches, contents):
    columns = ["file", "chunk", "line_id", "cells", "failure"]
    for name, source in contents(batches):
        records = _records_of(name, source)
        while rows := list(itertools.islice(records, ROWS_PER_BATCH)):
            yield pd.DataFrame(rows, columns=columns)


def spanning_records(spark: SparkSession, folder: str, files: DataFrame, extension: str = ".csv") -> DataFrame:
    """Records of the files whose quoted fields contain line breaks; such a file is read in order, by one task.

    A file that the binary source cannot hold as one value is parsed from its ordered pieces as they arrive. A file that cannot be read
    has no record.
    """
    ship_package(spark)
    limit = content_limit(spark)
    whole = _scan(spark, extension).format("binaryFile").load(folder).where(F.col("length") <= limit)
    wanted = whole.select(_base_name(F.col("path")).alias("file"), "content").join(files, "file", "left_semi")
    found = wanted.mapInPandas(partial(_read_spanning, contents=_whole_contents), RECORD_SCHEMA)
    large = filled_files(spark, folder, extension).where(F.col("length") > limit).join(files, "file", "left_semi")
    if large.isEmpty():
        return found
    ordered = _in_order(spark, folder, limit, extension, files)
    return found.unionByName(ordered.mapInPandas(partial(_read_spanning, contents=_ordered_contents), RECORD_SCHEMA))

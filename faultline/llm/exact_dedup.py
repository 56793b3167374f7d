"""Exact duplicates by a tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition yields a run: its distinct normalised texts as digests, each with the best row seen. In
each round groups of ``FAN_IN`` runs meet, are merged in digest order (the aggregation sorts, as its buffer is
a struct) and keep one row per digest, so a group of copies shrinks before it moves and never gathers in one task.
After the last round one run is left, spread over all tasks by digest.

A digest is trusted only together with the normalised text's byte length and a second, independent hash: rows
merge when all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faultline.llm.tables import WHITE, fresh_name, numbered
from faultline.session import stored

FAN_IN = 8
IDENTITY = ["digest", "norm_bytes", "check"]


def normalised(text: Column) -> Column:
    """The text without any white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per document: its identity as a text, its length in code points, and a row number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), normalised(F.col(text_col)).alias("norm"), row.alias("row_id"))
    return rows.select(
        "doc_id",
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.octet_length("norm").alias("norm_bytes"),
        F.xxhash64("norm").alias("check"),
        F.char_length("text").alias("code_points"),
        F.spark_partition_id().alias("run"),
        "row_id",
    )


def merged_runs(rows: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: ``best`` (the row that stays) and ``group_size``."""
    best = F.struct((-F.col("code_points")).alias("rank"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    merged = rows.select(*IDENTITY, (F.col("run") % runs).alias("run"), best.alias("best"), F.lit(1).cast("long").alias("group_size"))
    while True:
        merged = merged.groupBy("run", *IDENTITY).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
        if runs == 1:
            return merged.drop("run")
        runs = -(-runs // fan_in)
        merged = merged.withColumn("run", F.col("run") % runs)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without white space; a null text is empty. The row with the most code points
    stays, of several the smallest id (null last), of repeated rows with one id an arbitrary but single one. An empty
    table gives no rows. Other columns are ignored, whatever their names. ``runs``: leaf runs of the merge.
    """
    return _judged(docs, id_col, text_col, runs, fan_in).drop("row_id")


def _judged(docs: DataFrame, id_col: str, text_col: str, runs: int | None = None, fan_in: int = FAN_IN, row_col: str | None = None) -> DataFrame:
    runs = runs or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(digests(docs, id_col, text_col, row_col))
    groups = merged_runs(rows, runs, fan_in)
    kept = F.col("row_id") == F.col("best.row_id")
    return rows.join(groups, IDENTITY).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "row_id"
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those whose text another row, the one that stays, holds already; all columns."""
    row = fresh_name(docs, "row")
    rows = numbered(docs, row)
    gone = stored(_judged(rows, id_col, text_col, row_col=row).filter("not kept").select(F.col("row_id").alias(row)))  # its size decides how it is joined
    return rows.join(gone, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])

"""Judge a drop folder, and write the outcome."""

from __future__ import annotations

from functools import partial

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from faultline.operators import validation
from faultline.schema import SensorSchema
from faultline.session import ship_package, stored
from faultline.sources import folder as drop


def validate_folder(spark: SparkSession, folder: str, schema: SensorSchema, mode: str = "training",
                    pattern: str = validation.FILE_NAME_PATTERN, extension: str = ".csv") -> DataFrame:
    """Verdict table ``(file, sha256, spanning, reason, verdict, n_filled, target_name)``, one row per file.

    ``spanning`` marks files in which a quoted field contains a line break; ``n_filled`` counts the data records that are not
    blank. A file that cannot be read, or not to its end, is rejected and the others are judged. The table is stored, so that later steps read verdicts
    and hashes instead of the folder.
    """
    validation.check_mode(mode)
    lines = drop.line_records(drop.lines(spark, folder, extension), schema.types)
    chunks = stored(validation.chunk_facts(lines, schema))
    seen = chunks.groupBy("file").agg(F.sum("n_lines").alias("n_seen"))
    n_seen = F.coalesce("n_seen", F.lit(0))
    present = drop.filled_files(spark, folder, extension).select("file")
    headers = present.join(drop.digests(spark, folder, extension), "file", "left").join(seen, "file", "left").select(
        "file",
        "sha256",
        "header",
        F.lit(False).alias("spanning"),
        F.when(~F.col("n_lines").eqNullSafe(n_seen), drop.UNREAD).alias("unread"),
    )
    records = lines.select("file", "cells")
    spanning = chunks.where("open").select("file").distinct()
    if not spanning.isEmpty():
        whole = drop.spanning_records(spark, folder, spanning, extension).withColumn("blank", F.size("cells") == 0)
        first = whole.where(F.col("line_id") == 0).select("file", F.col("cells").alias("spanning_header"))
        expected = spanning.withColumn("expected", F.lit(True))
        headers = headers.join(first, "file", "left").join(expected, "file", "left").select(
            "file",
            "sha256",
            F.coalesce("spanning_header", "header").alias("header"),
            F.col("expected").isNotNull().alias("spanning"),
            F.coalesce("unread", F.when(F.col("expected") & F.col("spanning_header").isNull(), drop.UNREAD)).alias("unread"),
        )
        chunks = chunks.join(spanning, "file", "left_anti").unionByName(validation.chunk_facts(whole, schema))
        records = records.join(spanning, "file", "left_anti").unionByName(whole.select("file", "cells"))
    facts = validation.file_facts(chunks)
    longer = facts.where(F.col("narrowest") > len(schema.columns)).select("file")
    facts = validation.with_blank_extras(facts, records.join(longer, "file", "left_semi"), schema)
    judged = validation.verdicts(drop.list_files(spark, folder, extension), headers, facts, schema, mode, pattern)
    filled = chunks.groupBy("file").agg((F.sum("n_lines") - F.sum("n_blank") - 1).alias("n_filled"))
    return stored(judged.join(filled, "file", "left").withColumn(
        "target_name",
        F.when(F.col("verdict") == "good", validation.target_name(F.col("file"), F.col("sha256"))),
    ))


def write_verdicts(judged: DataFrame, path: str, mode: str) -> None:
    """Replace the verdict table; rejected files carry reason, time and mode."""
    bad = F.col("verdict") == "bad"
    judged.withColumn("mode", F.lit(mode)).withColumn(
        "rejected_at", F.when(bad, F.current_timestamp())
    ).write.mode("overwrite").partitionBy("verdict").parquet(path)


def _copy_partition(rows, folder, good_dir, bad_dir, mode):
    for row in rows:
        good = row["verdict"] == "good"
        target = f"{good_dir}/{row['target_name']}" if good else f"{bad_dir}/{row['file']}"
        pyarrow.fs.copy_files(f"{folder}/{row['file']}", target)
        if not good:
            system, error_path = pyarrow.fs.FileSystem.from_uri(target + ".error")
            with system.open_output_stream(error_path) as out:
                out.write(f"Error: {row['reason']}\nTimestamp: {row['now']}\nMode: {mode}\n".encode())


def _reset_folder(path: str) -> None:
    system, inner = pyarrow.fs.FileSystem.from_uri(path)
    system.create_dir(inner, recursive=True)
    system.delete_dir_contents(inner)


def route_files(judged: DataFrame, folder: str, good_dir: str, bad_dir: str, mode: str) -> None:
    """Empty the output folders, then copy every file to one of them, in parallel over files.

    Folders are absolute paths or URIs that each executor can reach.
    """
    ship_package(judged.sparkSession)
    _reset_folder(good_dir)
    _reset_folder(bad_dir)
    work = partial(_copy_partition, folder=folder, good_dir=good_dir, bad_dir=bad_dir, mode=mode)
    judged.select("file", "verdict", "reason", "target_name", F.current_timestamp().cast("string").alias("now")).foreachPartition(work)

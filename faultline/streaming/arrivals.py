"""Newly arrived files as a stream: the batch validation and load, once per group of files."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.operators import validation
from faultline.plans.load import load_prediction
from faultline.plans.validate import validate_folder
from faultline.schema import SensorSchema
from faultline.sources import folder as drop

FILES_PER_BATCH = 1000


def _literal(path: str) -> str:
    """Escape glob characters, so that a file name is never read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def empty_files(spark: SparkSession, folder: str, pattern: str = validation.FILE_NAME_PATTERN, extension: str = ".csv") -> DataFrame:
    """``(file, sha256, reason, verdict)`` of the folder's zero-byte files: those listed, without those that have any byte."""
    empty = drop.list_files(spark, folder, extension).join(drop.filled_files(spark, folder, extension), "file", "left_anti")
    reason = F.coalesce(validation.file_name_reason(F.col("file"), pattern), F.lit("File is empty"))
    return empty.select("file", F.sha2(F.lit(b""), 256).alias("sha256"), reason.alias("reason"), F.lit("bad").alias("verdict"))


def record(judged: DataFrame, ledger: str) -> None:
    """Append ``(file, sha256, reason, verdict, judged_at)`` for every file and content that the ledger does not hold yet.

    A file without a hash could not be read; it is recorded once, and again with its hash when it could.
    """
    spark = judged.sparkSession
    try:
        known = spark.read.parquet(ledger).select("file", F.col("sha256").alias("known"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        known = known.withColumnRenamed("file", "known_file")
        judged = judged.join(known, (F.col("file") == F.col("known_file")) & F.col("sha256").eqNullSafe(F.col("known")), "left_anti")
    judged.withColumn("judged_at", F.current_timestamp()).write.mode("append").parquet(ledger)


def append_arrivals(spark: SparkSession, folder: str, schema: SensorSchema, table_path: str, checkpoint: str,
                    pattern: str = validation.FILE_NAME_PATTERN, extension: str = ".csv",
                    files_per_batch: int = FILES_PER_BATCH, ledger: str | None = None) -> StreamingQuery:
    """Validate and append every file not seen yet, then stop.

    The stream's checkpoint remembers files; the append also skips ``(source_file, sha256)`` pairs already in
    the table, so a replayed batch adds nothing. ``ledger`` names a folder that keeps the verdicts, see ``record``; zero-byte files, for
    which a stream has no rows, are compared with it before the stream starts and get their verdict once.
    """
    if ledger is not None:
        record(empty_files(spark, folder, pattern, extension), ledger)
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"*{extension}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def load(batch: DataFrame, _: int) -> None:
        paths = [_literal(r["path"]) for r in batch.collect()]  # at most files_per_batch names
        if paths:
            judged = validate_folder(spark, paths, schema, "prediction", pattern, extension)
            load_prediction(spark, paths, judged, schema, table_path)
            if ledger is not None:
                record(judged.select("file", "sha256", "reason", "verdict"), ledger)

    return (
        arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

"""Typed reads of accepted files, and the tables between the stages."""

from __future__ import annotations

import uuid
from datetime import datetime
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from faultline.operators import loading
from faultline.schema import SensorSchema
from faultline.session import stored

REST = "unread_text"
#: How many cells beyond the declared ones the CSV reader makes room for in a row.
MORE_COLUMNS = 1 << 20
COPY_BUFFER = 1 << 16


def read_rows(spark: SparkSession, folder: str, schema: SensorSchema, style: str = "clean", extension: str = ".csv",
              multi_line: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Accepted files as text columns in schema order plus ``source_file``.

    ``wanted`` ``(source_file, n_filled, ...)`` names the files to keep, with further columns of theirs, and how many rows each must give: the
    rows are stored, and a file that gave another number, because its read failed, is left out.

    Column positions come from the declared schema; validation has compared every header with it. Blank lines
    are skipped and short rows padded. A file with an over-long row has no well-defined columns and is left
    out. ``multi_line`` reads each file in one task, for files whose quoted fields contain line breaks.
    """
    columns = schema.table_schema(style=style).names
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, REST)])
    # One column more than declared: it stays NULL unless a row is over-long.
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .option("maxColumns", len(columns) + MORE_COLUMNS)
        .option("maxCharsPerColumn", -1)
        .option("pathGlobFilter", f"*{extension}")
        .csv(folder)
        .withColumn("source_file", F.element_at(F.split(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/"), -1))
    )
    if wanted is not None:
        rows = loading.whole_files(stored(rows.join(wanted, "source_file"))).drop("n_filled")
    return loading.without_files(rows, F.col(REST).isNotNull()).drop(REST)


def replace_table(df: DataFrame, table: str) -> None:
    """Overwrite a catalog table ``database.name``, creating the database if needed."""
    database, _, _ = table.rpartition(".")
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a parquet folder whose files may have gained columns over time."""
    if "/" in name_or_path:
        return spark.read.option("mergeSchema", True).parquet(name_or_path)
    return spark.table(name_or_path)


def append_rows(rows: DataFrame, path: str) -> DataFrame:
    """Append rows whose ``(source_file, sha256)`` the table at ``path`` does not hold yet; new columns are allowed.

    Returns the appended rows' plan. A rerun appends nothing: what is loaded is read off the table itself.
    """
    spark = rows.sparkSession
    try:
        loaded = spark.read.parquet(path).select("source_file", "sha256").distinct()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        fresh = rows
    else:
        fresh = rows.join(loaded, ["source_file", "sha256"], "left_anti")
    stamped = fresh.withColumn("upload_timestamp", F.current_timestamp())
    stamped.write.mode("append").parquet(path)
    return stamped


def export_csv(df: DataFrame, folder: str) -> None:
    """CSV with header, one file per partition, replacing the folder."""
    df.write.mode("overwrite").option("header", True).csv(folder)


def export_one_csv(df: DataFrame, path: str) -> None:
    """CSV with one header in a single file, in the order of ``df``'s rows, replacing the file (or folder) at ``path``.

    Tasks write the rows as ordered parts beside ``path``; their bytes are then copied one part after the other through a small
    buffer, as most file systems cannot join files. The file appears under its name only when it is whole. ``export_csv`` has no single writer.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    work = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    head, rows, whole = (jvm.org.apache.hadoop.fs.Path(work, name) for name in ("head", "rows", "whole"))
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(df.columns))])
    try:
        spark.createDataFrame([tuple(df.columns)], names).coalesce(1).write.csv(head.toString())
        df.write.csv(rows.toString())
        out = files.create(whole)
        try:
            for folder in (head, rows):
                parts = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-")]
                for part in sorted(parts, key=lambda p: int(p.getName().split("-")[1])):
                    source = files.open(part)
                    try:
                        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BUFFER, False)
                    finally:
                        source.close()
        finally:
            out.close()
        files.delete(target, True)
        if not files.rename(whole, target):
            raise OSError(f"cannot write {path}")
    finally:
        files.delete(work, True)


def predictions_name(input_path: str, now: datetime | None = None) -> str:
    """Fixed format: the input's stem and a time stamp."""
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"predictions_{PurePosixPath(input_path).stem}_{stamp}.csv"

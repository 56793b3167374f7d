"""Load accepted files into the training table (replace) or the prediction table (append)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faultline.operators import loading
from faultline.schema import SensorSchema
from faultline.sources import tables


def accepted_rows(spark: SparkSession, folder: str, judged: DataFrame, schema: SensorSchema, mode: str,
                  style: str = "clean") -> DataFrame:
    """Typed rows of the good files in ``folder``, with ``source_file`` and ``sha256``.

    A good file that can no longer be read whole is left out; the others are loaded.
    """
    good = judged.where(F.col("verdict") == "good")

    def rows_of(files: DataFrame, multi_line: bool) -> DataFrame:
        wanted = files.select(F.col("file").alias("source_file"), "sha256", "n_filled")
        return tables.read_rows(spark, folder, schema, style, multi_line=multi_line, wanted=wanted)

    rows = rows_of(good.where(~F.col("spanning")), False)
    spanning = good.where("spanning")
    if not spanning.isEmpty():
        rows = rows.unionByName(rows_of(spanning, True))
    return loading.typed_rows(rows, schema, mode, style)


def load_training(spark: SparkSession, folder: str, judged: DataFrame, schema: SensorSchema, table: str) -> DataFrame:
    rows = accepted_rows(spark, folder, judged, schema, "training").drop("sha256", "source_file")
    tables.replace_table(rows, table)
    return spark.table(table)


def load_prediction(spark: SparkSession, folder: str, judged: DataFrame, schema: SensorSchema, path: str) -> DataFrame:
    tables.append_rows(accepted_rows(spark, folder, judged, schema, "prediction"), path)
    return tables.read_table(spark, path)

"""Wafer-shaped views of the driver's tables: files, sensor rows, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faultline.schema import training_schema

# Wafer id, four sensors, label.
SCHEMA = training_schema(6)
SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DEFECTS = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_name(key: Column) -> Column:
    """An order stands for a file; every eleventh has a malformed name."""
    stamp = F.concat(
        F.lpad((key % 100_000_000).cast("string"), 8, "0"),
        F.lit("_"),
        F.lpad(F.floor(key / 100_000_000).cast("string"), 6, "0"),
    )
    return F.concat(
        F.lit("wafer_"), F.when(key % DEFECTS == 1, F.concat(F.lit("x"), key.cast("string"))).otherwise(stamp), F.lit(".csv")
    )


def files(lineitem: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    return lineitem.select("l_orderkey").distinct().select(file_name(key).alias("file"), (key % DEFECTS).alias("defect"))


def headers(lineitem: DataFrame) -> DataFrame:
    """``(file, header)`` of the files that have any line."""
    defect = F.col("defect")
    header = (
        F.when(defect == 0, F.lit(["Wafer", "Sensor - 1", "sensor-2", "SENSOR - 3", "Sensor  4", "Good/Bad"]))
        .when(defect == 3, F.array().cast("array<string>"))
        .when(defect == 4, F.lit(["wafer", "Sensor - 1", "Sensor - 2", "Sensor - 3", "Sensor - 4", "Result"]))
        .when(defect == 5, F.lit(["wafer", "Sensor - 1", "Sensor - 2", "Sensor - 3", "Output"]))
        .when(defect == 6, F.lit(["wafer", "Sensor - 2", "Sensor - 1", "Sensor - 3", "Sensor - 4", "Output"]))
        .otherwise(F.lit(["", "Sensor - 1", "Sensor - 2", "Sensor - 3", "Sensor - 4", "Output"]))
    )
    return files(lineitem).where(defect != 2).select("file", header.alias("header"))


def records(lineitem: DataFrame) -> DataFrame:
    """``(file, chunk, line_id, cells)``: the header as line 0, then one line per item."""
    defect, line = F.col("l_orderkey") % DEFECTS, F.col("l_linenumber")

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    second = F.when((defect == 7) & (line % 3 == 0), "abc").otherwise(text("l_extendedprice"))
    third = F.when((defect == 0) & (line == 1), " inf ").when((defect == 0) & (line == 2), " ").when(
        (defect == 0) & (line == 3), "1_000").otherwise(text("l_discount"))
    label = F.when((defect == 8) & (line >= 4), "1.0").when(F.col("l_returnflag") == "R", "-1").otherwise("1")
    full = F.array(text("l_partkey"), text("l_quantity"), second, third, text("l_tax"), label)
    cells = F.when(defect == 10, F.array_repeat(F.lit(""), 6)).otherwise(full)
    body = lineitem.where(~defect.isin(2, 9)).select(
        file_name(F.col("l_orderkey")).alias("file"),
        F.lit(0).cast("bigint").alias("chunk"),
        line.cast("bigint").alias("line_id"),
        cells.alias("cells"),
    )
    top = headers(lineitem).select("file", F.lit(0).cast("bigint").alias("chunk"), F.lit(0).cast("bigint").alias("line_id"), F.col("header").alias("cells"))
    return top.unionByName(body)


def short_records(lineitem: DataFrame) -> DataFrame:
    """``(file, chunk, line_id, cells)`` with one to six cells a row; some third cells, where there, are no numbers."""
    third = F.when(F.col("l_suppkey") % 5 == 0, "abc").otherwise(F.col("l_extendedprice").cast("string"))
    full = F.array(F.col("l_partkey").cast("string"), F.col("l_quantity").cast("string"), third, F.col("l_discount").cast("string"),
                   F.col("l_tax").cast("string"), F.lit("1"))
    file, chunk = file_name(F.col("l_orderkey")).alias("file"), F.lit(0).cast("bigint").alias("chunk")
    body = lineitem.select(
        file, chunk, F.col("l_linenumber").cast("bigint").alias("line_id"), F.slice(full, F.lit(1), (F.col("l_partkey") % 6 + 1).cast("int")).alias("cells")
    )
    header = F.lit(["wafer", "Sensor - 1", "Sensor - 2", "Sensor - 3", "Sensor - 4", "Output"]).alias("cells")
    top = lineitem.select("l_orderkey").distinct().select(file, chunk, F.lit(0).cast("bigint").alias("line_id"), header)
    return top.unionByName(body)


def sensor_rows(lineitem: DataFrame) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.array(*SENSORS).alias("sensors"), label.alias("label"))


def vectors(embeddings: DataFrame) -> DataFrame:
    """``(row_key, sensors, label)`` with labels 0/1."""
    return embeddings.select(
        F.col("vec_id").alias("row_key"),
        F.col("embedding").cast("array<double>").alias("sensors"),
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"),
    )


def gappy_vectors(embeddings: DataFrame, step: int = 7) -> DataFrame:
    """The same with every ``step``-th coordinate missing, shifted by the key."""
    rows = vectors(embeddings)
    gaps = F.transform("sensors", lambda v, i: F.when((F.col("row_key") + i) % step != 0, v))
    return rows.withColumn("sensors", gaps)


def scored_rows(lineitem: DataFrame) -> DataFrame:
    """``(wafer_id, cluster, prediction, probability)`` from fixed columns."""
    p = F.col("l_discount") * 10
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("wafer_id"),
        (F.col("l_linenumber") % 3).cast("int").alias("cluster"),
        (p > 0.5).cast("int").alias("prediction"),
        p.alias("probability"),
    )

"""From accepted files to typed tables: naming, coercion, file-level filters, provenance, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from faultline.functions import literals, names
from faultline.schema import SensorSchema

WAFER = "wafer"
PROVENANCE = ("source_file", "sha256", "upload_timestamp")


def rename_columns(df: DataFrame, style: str = "clean") -> DataFrame:
    """Unnamed first column -> wafer id, cleaned names, label spellings -> ``output``."""
    columns = list(df.columns)
    if columns[0].strip().lower() in ("", "unnamed: 0", "_c0"):
        columns[0] = WAFER
    rule = names.table_column if style == "clean" else names.clean_name_underscored
    return df.toDF(*[rule(c) for c in columns])


def schema_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Columns in schema order, those the frame has."""
    return df.select(*[c for c in order if c in df.columns])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by name; a column missing on one side is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def coerce(col: Column, kind: T.DataType) -> Column:
    """Value of a text cell as ``kind``; unparseable text is NULL, missing text stays NULL."""
    if isinstance(kind, T.DoubleType):
        return literals.to_double(col)
    if isinstance(kind, T.LongType):
        return _whole(col)
    if isinstance(kind, T.BooleanType):
        return col.try_cast("boolean")
    return col.cast("string")


def _whole(col: Column) -> Column:
    """Integer text is read exactly; only other numbers go through a double. NULL beyond 64 bits."""
    value = literals.to_double(col)
    return F.coalesce(col.try_cast("bigint"), F.when(F.abs(value) < 2.0**63, value.cast("bigint")))


def breaks_integer(col: Column) -> Column:
    """True for a number that an integer column cannot hold: a fraction, or one beyond 64 bits."""
    value = literals.to_double(col)
    return F.coalesce((value != F.floor(value)) | _whole(col).isNull(), F.lit(False)) & value.isNotNull()


def without_files(rows: DataFrame, defect: Column, file: str = "source_file") -> DataFrame:
    """Drop every row of a file in which any row shows ``defect``.

    Only the names of defective files are joined back, so the rows themselves need no shuffle while that list
    is small enough for Spark to broadcast, and a large file is never gathered in one place.
    """
    bad = rows.where(defect).select(file).distinct()
    return rows.join(bad, file, "left_anti")


def whole_files(rows: DataFrame, expected: str = "n_filled", file: str = "source_file") -> DataFrame:
    """Drop every row of a file whose number of rows is not the ``expected`` one, which its rows carry."""
    counted = rows.groupBy(file).agg(F.count("*").alias("n"), F.max(expected).alias("expected"))
    return rows.join(counted.where(F.col("n") != F.col("expected")).select(file), file, "left_anti")


def missing_wafer(wafer: Column) -> Column:
    return wafer.isNull() | (wafer == "")


def typed_rows(rows: DataFrame, schema: SensorSchema, mode: str, style: str = "clean") -> DataFrame:
    """Text rows in schema order plus other columns -> typed rows; files that cannot be loaded are left out.

    A training file goes when any wafer id is missing, a prediction file when an integer column holds a
    fraction.
    """
    kinds = {f.name: f.dataType for f in schema.table_schema(mode, style)}
    if mode == "training":
        rows = without_files(rows, missing_wafer(F.col(WAFER)))
    integers = [n for n, k in kinds.items() if isinstance(k, T.LongType) and n in rows.columns]
    if mode == "prediction" and integers:
        rows = without_files(rows, reduce(lambda a, b: a | b, [breaks_integer(F.col(n)) for n in integers]))
    others = [c for c in rows.columns if c not in kinds]
    return rows.select(*[coerce(F.col(n), k).alias(n) for n, k in kinds.items() if n in rows.columns], *others)


def column_manifest(df: DataFrame) -> DataFrame:
    """One row with the loaded column names."""
    return df.sparkSession.createDataFrame([(", ".join(df.columns),)], "columns string")

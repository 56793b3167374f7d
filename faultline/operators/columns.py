"""Feature columns: which to keep, labels, and mean or mode fill.

Sensors travel as one ``ARRAY<DOUBLE>`` column (or ``ARRAY<STRING>`` before typing), never as hundreds of
aggregate columns. Statistics explode that array and aggregate at once, so the shuffle carries one row per
position and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faultline.functions import literal_arrays as constants, literals
from faultline.session import stored

# Label headers, in order of preference, and id headers of a prediction table.
LABEL_COLUMNS = ("Output", "output", "Good/Bad", "goodbad")
ID_COLUMNS = ("wafer", "unnamed: 0", "wafer_id", "id")
NOT_FEATURES = ("source_file", "sha256", "upload_timestamp")
UNKNOWN = "Unknown"


def marker_to_null(df: DataFrame) -> DataFrame:
    """``?`` becomes NULL in every text column."""
    return df.select(*[
        literals.missing_to_null(F.col(f"`{n}`")).alias(n) if kind == "string" else F.col(f"`{n}`") for n, kind in df.dtypes
    ])


def drop_wafer(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "Wafer"])


def feature_columns(columns: list[str], label_options=LABEL_COLUMNS) -> tuple[list[str], str]:
    """Names of the features and of the label: the first label option present; wafer ids are no features."""
    label = next((c for c in label_options if c in columns), None)
    if label is None:
        raise KeyError(f"no label: the table has none of {', '.join(label_options)} among its {len(columns)} columns")
    return [c for c in columns if c != label and c.strip().lower() != "wafer" and c not in NOT_FEATURES], label


def recode_label(label: Column) -> Column:
    return F.when(label == -1, 0).otherwise(label)


def id_column(columns: list[str]) -> str | None:
    """The wafer id column of a prediction table, by name, ignoring case."""
    by_name = {c.lower(): c for c in reversed(columns)}
    return next((by_name[c] for c in ID_COLUMNS if c in by_name), None)


def with_position(df: DataFrame, name: str = "wafer_id") -> DataFrame:
    """Number the rows 0..n-1 in scan order: rows of earlier partitions plus the place in the own one.

    The rows and their places are stored once, so that both uses of them agree; only one count per partition is shuffled.
    """
    local = F.monotonically_increasing_id()
    placed = stored(df.select("*", F.shiftright(local, 33).alias("_part"), local.bitwiseAND((1 << 33) - 1).alias("_place")))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the scan, so the single-task running sum is small.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))


def pack(columns: list[str], kind: str = "double") -> Column:
    """The named columns as one array."""
    return F.array(*[F.col(f"`{c}`").cast(kind) for c in columns])


def position_stats(df: DataFrame, array: str = "sensors") -> DataFrame:
    """Per position: rows, rows with a value, minimum, maximum, mean."""
    return df.select(F.posexplode(array).alias("position", "value")).groupBy("position").agg(
        F.count("*").alias("rows"),
        F.count("value").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("value").alias("mean"),
    )


def zero_variance(stats: DataFrame) -> Column:
    """One distinct value in at least two rows; a single value has no variance to be zero."""
    return (F.col("n") >= 2) & (F.col("low") == F.col("high"))


def all_null(stats: DataFrame) -> Column:
    return F.col("n") == 0


def project(array: Column, positions: list[int]) -> Column:
    """The array's elements at ``positions``, in that order."""
    return F.transform(constants.ints(positions), lambda p: F.get(array, p))


def fill(array: Column, values: list[float]) -> Column:
    """NULL elements replaced by the fitted value of their position."""
    return F.zip_with(array, constants.doubles(values), lambda x, v: F.coalesce(x, v))


def modes(df: DataFrame, position: str = "position", value: str = "value") -> DataFrame:
    """Most frequent value per position, the smallest one on ties.

    Counts per value first, so that no task holds all values of a position.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(position, value).agg(F.count("*").alias("n"))
    return counted.groupBy(position).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"))


def text_profile(df: DataFrame, array: str = "cells") -> DataFrame:
    """Per position of a text array: values, ``?`` markers, texts that are no number, mean of the numbers.

    ``numeric`` is true when the column holds numbers only; such a column is filled by its mean. A column
    with a marker or other text is filled by its mode, and may still convert to numbers afterwards.
    """
    text = literals.missing_to_null(F.col("value"))
    number = literals.to_double(text)
    missing = literals.is_missing(text)
    present = F.coalesce(~missing, F.lit(False))
    return (
        df.select(F.posexplode(array).alias("position", "value"))
        .groupBy("position")
        .agg(
            F.count_if(present).alias("n"),
            F.count_if(F.col("value") == "?").alias("n_markers"),
            F.count_if(present & number.isNull()).alias("n_text"),
            F.avg(literals.to_finite(text)).alias("mean"),
        )
        .select("*", ((F.col("n_markers") == 0) & (F.col("n_text") == 0)).alias("numeric"), (F.col("n_text") == 0).alias("converts"))
    )


def clean_text(array: Column) -> Column:
    """Elements that stand for a missing value become NULL: blanks, ``?`` and the usual spellings."""
    return F.transform(array, lambda c: F.when(~literals.is_missing(c), c))


def prepare_batch(df: DataFrame, columns: list[str], array: str = "cells") -> tuple[DataFrame, list[str], list[str]]:
    """Fill a prediction batch from its own statistics.

    ``array`` holds the text cells of ``columns``. Returns the frame with ``sensors`` (numbers) and ``texts``
    instead, and the column names of both. All-null columns go; number columns take their mean, others their
    mode. Two passes at most: the profile, and value counts of the columns that need a mode.
    """
    profile = {r["position"]: r for r in text_profile(df, array).collect()}
    kept = [p for p in range(len(columns)) if p in profile and profile[p]["n"] > 0]
    by_mode = [p for p in kept if not profile[p]["numeric"]]
    fills: dict[int, str] = {}
    if by_mode:
        exploded = df.select(F.posexplode(clean_text(F.col(array))).alias("position", "value"))
        fills = {r["position"]: r["mode"] for r in modes(exploded.where(F.col("position").isin(by_mode))).collect()}
    numbers = [p for p in kept if profile[p]["converts"]]
    texts = [p for p in kept if not profile[p]["converts"]]
    clean = clean_text(F.col(array))
    means = [float(fills[p]) if p in fills else profile[p]["mean"] or 0.0 for p in numbers]  # 0 if no value is finite
    filled = df.select(
        *[c for c in df.columns if c != array],
        fill(F.transform(project(clean, numbers), literals.to_finite), means).alias("sensors"),
        F.zip_with(
            project(clean, texts), F.lit([fills.get(p, UNKNOWN) for p in texts]).cast("array<string>"), lambda x, v: F.coalesce(x, v)
        ).alias("texts"),
    )
    return filled, [columns[p] for p in numbers], [columns[p] for p in texts]

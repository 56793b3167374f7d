"""File acceptance rules: one reason per file, the first rule that fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faultline.functions import literal_arrays as constants, literals, names
from faultline.schema import MODES, SensorSchema

# The reason texts in this module, as the reports spell them.
# Fixed value: the file-name pattern.
FILE_NAME_PATTERN = r"^wafer_\d{8}_\d{6}\.csv$"
# Accepted label headers, and headers that stand for an unnamed first column.
LABEL_HEADERS = ("output", "good/bad")
UNNAMED_HEADERS = ("", "unnamed: 0")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, known are {', '.join(MODES)}")


# -- rules on the file name and the header ------------------------------------------------------------------


def file_name_reason(file: Column, pattern: str = FILE_NAME_PATTERN) -> Column:
    return F.when(~file.rlike(rf"(?U)\A(?:{pattern})"), "Invalid filename format")


def named_header(header: Column) -> Column:
    """An unnamed first column is the wafer id."""
    first = F.when(F.lower(header[0]).isin(*UNNAMED_HEADERS), "Wafer").otherwise(header[0])
    return F.when(F.size(header) > 0, F.concat(F.array(first), F.slice(header, 2, F.greatest(F.size(header) - 1, F.lit(0)))))


def header_reason(header: Column, schema: SensorSchema, mode: str) -> Column:
    """Reason for an unacceptable header; ``header`` is as read, with its unnamed first cell not yet replaced."""
    check_mode(mode)
    labelled = mode == "training"
    compared = schema.names[:-1] if labelled else schema.names
    expected = constants.strings(names.normalize_name(n) for n in compared)
    n_got = F.size(header) - (1 if labelled else 0)
    last = F.element_at(named_header(header), -1)
    reason = F.when(F.size(header) == 0, "Header is empty")
    if labelled:
        reason = reason.when(
            ~names.normalize(last).isin(*LABEL_HEADERS),
            F.concat(F.lit("Last column should be 'Output' or 'Good/Bad', got '"), last, F.lit("'")),
        )
    return reason.when(
        n_got != len(compared),
        F.concat(F.lit(f"Column count mismatch: expected {len(compared)}, got "), n_got.cast("string")),
    ).when(
        F.transform(F.slice(named_header(header), 1, len(compared)), names.normalize) != expected,
        "Columns do not match schema",
    )


# -- rules on the cells -------------------------------------------------------------------------------------


def first_bad_position(cells: Column, schema: SensorSchema) -> Column:
    """1-based position of the first cell that does not fit its column's type, 0 if all fit."""
    families = [literals.CHECKED_TYPES.get(kind) for kind in schema.types]
    family = constants.ints({"float": 1, "integer": 2}.get(f, 0) for f in families)

    def unfit(cell: Column, i: Column) -> Column:
        kind = F.get(family, i)
        fits = F.when(kind == 1, literals.fits(cell, "float")).when(kind == 2, literals.fits(cell, "integer"))
        return F.coalesce(~fits, F.lit(False)) & ~literals.is_blank(cell)

    return F.array_position(F.transform(F.slice(cells, 1, len(families)), unfit), True)


def _filled_span(cells: Column, width: int) -> tuple[Column, Column]:
    """First and last non-blank position among the schema's columns; most rows are filled at both ends."""
    filled = F.transform(F.slice(cells, 1, width), lambda c: ~literals.is_blank(c))
    low = F.array_position(filled, True)
    high = width + 1 - F.array_position(
        F.reverse(F.concat(filled, F.array_repeat(F.lit(False), width - F.size(filled)))), True
    )
    both = (F.size(cells) >= width) & ~literals.is_blank(F.get(cells, F.lit(0))) & ~literals.is_blank(F.get(cells, F.lit(width - 1)))
    return (
        F.when(both, F.lit(1)).when(low > 0, low),
        F.when(both, F.lit(width)).when(low > 0, high),
    )


def chunk_facts(records: DataFrame, schema: SensorSchema) -> DataFrame:
    """Reduce records ``(file, chunk, line_id, cells[, failure, open, plain])`` to a few rows per file split.

    A ``plain`` record is known to be filled at both ends and to fit the schema.

    A line that could be the header (its first typed cell carries that column's name) keeps a group of its
    own, so that the true header can be told from repeated ones afterwards; all other lines of a split
    collapse map-side into one row.
    """
    width = len(schema.columns)
    cells = F.col("cells")
    failure = F.col("failure") if "failure" in records.columns else F.lit(None).cast("string")
    opened = F.col("open") if "open" in records.columns else F.lit(False)
    plain = F.col("plain") if "plain" in records.columns else F.lit(False)
    blank = F.col("blank") if "blank" in records.columns else F.lit(False)
    header_like = _header_like(cells, schema)
    low, high = _filled_span(cells, width)
    checked = records.select(
        "file",
        "chunk",
        "line_id",
        F.when(~plain & header_like, F.col("line_id")).alias("header_id"),
        F.when(plain, width).otherwise(F.size(cells)).alias("n_cells"),
        F.when(plain, F.lit(0)).otherwise(first_bad_position(cells, schema)).alias("position"),
        F.when(plain, F.lit(1)).otherwise(low).alias("low"),
        F.when(plain, F.lit(width)).otherwise(high).alias("high"),
        failure.alias("failure"),
        opened.alias("open"),
        blank.alias("blank"),
        "cells",
    ).select(
        "*",
        F.when(F.col("failure").isNotNull(), F.struct("line_id", F.lit(0).cast("bigint").alias("position"), F.col("failure").alias("text")))
        .when(F.col("position") > 0, F.struct("line_id", "position", F.get(cells, (F.col("position") - 1).cast("int")).alias("text")))
        .alias("error"),
    ).drop("cells")
    return checked.groupBy("file", "chunk", "header_id").agg(
        F.count("*").alias("n_lines"),
        F.min("line_id").alias("first_id"),
        F.min("error").alias("error"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min(F.greatest(F.col("n_cells"), F.lit(width))).alias("narrowest"),
        F.max("open").alias("open"),
        F.count_if("blank").alias("n_blank"),
    )


def _header_like(cells: Column, schema: SensorSchema) -> Column:
    """Whether a line may be the header: by its first typed column's name, any label spelling, or else its first cell."""
    typed = next((i for i, kind in enumerate(schema.types) if kind in literals.CHECKED_TYPES), None)
    if typed is None:
        return F.lower(F.get(cells, F.lit(0))).isin(*UNNAMED_HEADERS) | (names.normalize(F.get(cells, F.lit(0))) == names.normalize_name(schema.names[0]))
    spellings = {names.normalize_name(schema.names[typed])}
    if typed == len(schema.columns) - 1:
        spellings |= set(LABEL_HEADERS)
    return names.normalize(F.get(cells, F.lit(typed))).isin(*sorted(spellings))


def with_blank_extras(facts: DataFrame, records: DataFrame, schema: SensorSchema) -> DataFrame:
    """``file_facts`` with ``blank_extra``: every row is longer than the schema, and some cell past it is blank in all rows.

    Filled positions past the schema are counted per file, whatever their number; only over-long lines take part, and their positions
    combine before they are shuffled.
    """
    width = len(schema.columns)
    over = F.col("narrowest") - width
    longer = facts.where(over > 0).select("file", over.alias("over"))
    beyond = records.where(F.size("cells") > width).select("file", F.posexplode(F.slice("cells", F.lit(width + 1), F.size("cells"))).alias("place", "cell"))
    filled = beyond.where(~literals.is_blank(F.col("cell"))).groupBy("file", "place").agg(F.count("*").alias("n"))
    counted = filled.join(longer, "file").where(F.col("place") < F.col("over")).groupBy("file").agg(F.count("*").alias("n_filled"))
    blank = (over > 0) & (F.coalesce("n_filled", F.lit(0)) < over)
    return facts.join(counted, "file", "left").withColumn("blank_extra", F.coalesce(blank, F.lit(False))).drop("n_filled")


def file_facts(chunks: DataFrame) -> DataFrame:
    """Merge the splits of each file: row numbers, first error, filled columns.

    Works on the few rows per split that ``chunk_facts`` leaves, not on lines.
    """
    in_file = Window.partitionBy("file").orderBy("chunk")
    numbered = chunks.select(
        "*",
        F.coalesce(F.sum("n_lines").over(in_file.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.min("first_id").over(in_file.rangeBetween(0, 0)).alias("chunk_start"),
        F.min("chunk").over(in_file.rangeBetween(Window.unboundedPreceding, 0)).alias("first_chunk"),
    )
    is_header = (
        (F.col("chunk") == F.col("first_chunk"))
        & (F.col("first_id") == F.col("chunk_start"))
        & F.col("header_id").isNotNull()
    )
    row_number = F.col("before") + F.col("error.line_id") - F.col("chunk_start") + 1
    body = numbered.select(
        "file",
        "n_lines",
        is_header.alias("is_header"),
        "low",
        "high",
        "narrowest",
        F.when(
            F.col("error").isNotNull(),
            F.struct(row_number.alias("row_num"), F.col("error.position").alias("position"), F.col("error.text").alias("text")),
        ).alias("error"),
    )
    data = ~F.col("is_header")
    return body.groupBy("file").agg(
        (F.sum("n_lines") - 1).alias("n_rows"),
        F.min(F.when(data | (F.col("error.position") == 0), F.col("error"))).alias("error"),
        F.min(F.when(data, F.col("low"))).alias("low"),
        F.max(F.when(data, F.col("high"))).alias("high"),
        F.min(F.when(data, F.col("narrowest"))).alias("narrowest"),
    )


def cell_reason(header: Column, schema: SensorSchema) -> Column:
    """Reason from the first failing cell of ``file_facts``."""
    kinds = constants.strings(schema.types)
    position = F.col("error.position").cast("int")
    named = named_header(header)
    return F.when(
        position == 0, F.concat(F.lit("Processing error: "), F.col("error.text"))
    ).when(
        position > 0,
        F.concat(
            F.lit("Row "), F.col("error.row_num").cast("string"), F.lit(": Column '"), F.get(named, position - 1),
            F.lit("' expects "), F.get(kinds, position - 1), F.lit(", got '"), F.col("error.text"), F.lit("'"),
        ),
    )


def blank_columns_reason(schema: SensorSchema, mode: str) -> Column:
    """From ``with_blank_extras``. All-blank columns number at least the feature columns: at most one filled column in training, none in
    prediction. An all-blank column past the header has no name to report, which is a failure of its own."""
    check_mode(mode)
    none_filled = F.col("low").isNull()
    too_few = none_filled | (F.col("low") == F.col("high")) if mode == "training" else none_filled
    return F.when(F.col("blank_extra"), "Processing error: list index out of range").when(too_few, "All feature columns contain only null values")


def verdicts(files: DataFrame, headers: DataFrame, facts: DataFrame, schema: SensorSchema, mode: str,
             pattern: str = FILE_NAME_PATTERN) -> DataFrame:
    """``files`` (file) + ``headers`` (file, header, ...) + ``file_facts`` -> the same files with ``reason``/``verdict``.

    ``unread`` in ``headers``, if there, is the failure of a file that could not be read.
    """
    unread = F.col("unread") if "unread" in headers.columns else F.lit(None).cast("string")
    joined = files.join(headers, "file", "left").join(facts, "file", "left")
    header = F.col("header")
    header_error = F.col("error.position").eqNullSafe(0) & (F.col("error.row_num") == 1)
    reason = F.coalesce(
        file_name_reason(F.col("file"), pattern),
        F.concat(F.lit("Processing error: "), unread),
        F.when(F.col("n_rows").isNull(), "File is empty"),
        F.when(header_error, F.concat(F.lit("Processing error: "), F.col("error.text"))),
        header_reason(header, schema, mode),
        cell_reason(header, schema),
        F.when(F.col("n_rows") == 0, "File contains no data rows"),
        blank_columns_reason(schema, mode),
    )
    kept = [c for c in headers.columns if c not in ("file", "header", "unread")]
    return joined.select("file", *kept, reason.alias("reason")).select(
        "*", F.when(F.col("reason").isNull(), "good").otherwise("bad").alias("verdict")
    )


def target_name(file: Column, sha256: Column) -> Column:
    """Accepted files carry the first eight digits of their content hash."""
    dot = F.length(file) - F.length(F.substring_index(file, ".", -1))
    return F.concat(file.substr(F.lit(1), dot - 1), F.lit("_"), F.substring(sha256, 1, 8), file.substr(dot, F.length(file)))


def summary(judged: DataFrame) -> DataFrame:
    total = F.count("*")
    good = F.count_if(F.col("verdict") == "good")
    good_pct = F.try_divide(100 * good, total)  # NULL for an empty folder
    return judged.agg(
        total.alias("total"),
        good.alias("good"),
        F.round(good_pct, 1).alias("good_pct"),
        (total - good).alias("bad"),
        F.round(100 - good_pct, 1).alias("bad_pct"),
    )


def rejections(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == "bad").select("file", "reason")

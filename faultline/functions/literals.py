"""Which cell texts count as a number, stated as patterns rather than as casts.

``try_cast`` is both too strict (``1_000``) and too lax (``1.0d``, ``0x1p3``), so validity is decided here
and casts are used for values only.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted integer and float literals.
BLANK = r"\s*+"
DIGITS = r"\d++(?:_\d++)*+"
INTEGER_PATTERN = rf"(?U)\A{BLANK}[+-]?{DIGITS}{BLANK}\z"
FLOAT_PATTERN = (
    rf"(?iU)\A{BLANK}[+-]?(?:(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:e[+-]?{DIGITS})?|inf(?:inity)?|nan){BLANK}\z"
)
# What nearly all cells look like: a subset of the two patterns above that matches much faster.
PLAIN_INTEGER = r"\A[+-]?[0-9]++\z"
PLAIN_FLOAT = r"\A[+-]?[0-9]++(?:\.[0-9]*+)?(?:[eE][+-]?[0-9]++)?\z"
NON_BLANK_PATTERN = r"(?U)[^\s\x1c-\x1f]"

# Texts that a CSV read takes for a missing value, besides blanks.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)

# JSON type name -> checked family; other names are not checked.
CHECKED_TYPES = {"float": "float", "double": "float", "int": "integer", "integer": "integer"}


# A comma that is followed by neither a plain number nor an empty cell.
IRREGULAR_CELL = r",(?!(?:[+-]?[0-9]++(?:\.[0-9]*+)?(?:[eE][+-]?[0-9]++)?)?+(?:,|\z))"
FILLED_FIRST_CELL = r"\A[^,]*[^\s\x1c-\x1f\x85\p{Z},][^,]*,"


def is_plain_line(line: Column, kinds: list[str]) -> Column:
    """True only for an unquoted line with every column present, an id, plain numbers or gaps, and a filled last cell.

    Nearly all lines of a sound file are like that; four scans of the text settle them without building cells.
    Always false unless the columns are an unchecked one, floats, and a last one that is float or integer.
    """
    families = [CHECKED_TYPES.get(kind) for kind in kinds]
    if len(families) < 2 or families[0] is not None or set(families[1:-1]) - {"float"} or families[-1] is None:
        return F.lit(False)
    last = F.substring_index(line, ",", -1)
    return (
        ~line.contains('"')
        & (F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) == len(kinds) - 1)
        & last.rlike(PLAIN_INTEGER if families[-1] == "integer" else PLAIN_FLOAT)
        & line.rlike(FILLED_FIRST_CELL)
        & ~line.rlike(IRREGULAR_CELL)
    )


def is_blank(cell: Column) -> Column:
    return ~cell.rlike(NON_BLANK_PATTERN)


def fits(cell: Column, family: str) -> Column:
    if family == "float":
        return cell.rlike(PLAIN_FLOAT) | cell.rlike(FLOAT_PATTERN)
    return cell.rlike(PLAIN_INTEGER) | cell.rlike(INTEGER_PATTERN)


def missing_to_null(cell: Column) -> Column:
    """The ``?`` marker becomes NULL."""
    return F.nullif(cell, F.lit("?"))


def is_missing(cell: Column) -> Column:
    """Blank, a spelling of a missing value, or the ``?`` marker."""
    return is_blank(cell) | cell.isin(*MISSING_TEXTS, "?") | (F.lower(cell) == "nan")


def to_finite(cell: Column) -> Column:
    """``to_double`` for a sensor: an infinite reading is no reading, hence NULL."""
    value = to_double(cell)
    return F.when(F.abs(value) != float("inf"), value)


def to_double(cell: Column) -> Column:
    """Numeric value of a text or number, NULL when unparseable; NaN is a missing value, hence NULL."""
    value = cell.try_cast("double")
    return F.when(~F.isnan(value), value)

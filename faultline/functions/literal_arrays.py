"""Fitted number lists as array constants.

One SQL text per array: building them literal by literal costs a round trip to the JVM per number, which a
list with one entry per sensor makes noticeable.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _number(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"DOUBLE('{value!r}')"


def _doubles(values: Iterable[float | None]) -> str:
    return f"CAST(array({', '.join(map(_number, values))}) AS ARRAY<DOUBLE>)"


def doubles(values: Iterable[float | None]) -> Column:
    return F.expr(_doubles(values))


def double_rows(rows: Iterable[Iterable[float | None]]) -> Column:
    return F.expr(f"CAST(array({', '.join(map(_doubles, rows))}) AS ARRAY<ARRAY<DOUBLE>>)")


def ints(values: Iterable[int]) -> Column:
    return F.expr(f"CAST(array({', '.join(str(int(v)) for v in values)}) AS ARRAY<INT>)")


def strings(values: Iterable[str]) -> Column:
    """Texts without the unit-separator character, which joins them here."""
    joined = "\x1f".join(values)
    return F.split(F.lit(joined), "\x1f") if joined else F.expr("CAST(array() AS ARRAY<STRING>)")

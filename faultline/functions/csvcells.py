"""One text line to its cells, in JVM expressions.

Lines without a quote are a plain split. Lines with quotes follow the usual rules: a quote opens only at the
start of a field, ``""`` inside is a literal quote, and text after the closing quote is kept as it is. A line
whose last quoted field never closes continues on the next line; ``is_open`` finds those.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
FIELD = rf',({QUOTED}[^,]*|[^",][^,]*|)'


def _fields(line: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD), F.lit(1))


def _unquote(field: Column) -> Column:
    body = F.regexp_extract(field, rf"(?s)^({QUOTED})", 1)
    inner = F.replace(body.substr(F.lit(2), F.length(body) - 2), F.lit('""'), F.lit('"'))
    rest = field.substr(F.length(body) + 1, F.length(field))
    return F.when(field.startswith('"'), F.concat(inner, rest)).otherwise(field)


def cells(line: Column) -> Column:
    """``ARRAY<STRING>``; a blank line has no cells at all."""
    quoted = F.transform(_fields(line), _unquote)
    return (
        F.when(line == "", F.array().cast("array<string>"))
        .when(line.contains("\""), quoted)
        .otherwise(F.split(line, ",", -1))
    )


def is_open(line: Column) -> Column:
    """True when a quoted field runs past the end of the line."""
    covered = F.aggregate(
        _fields(line), F.lit(0), lambda total, field: total + F.length(field) + 1
    )
    return line.contains("\"") & (covered != F.length(line) + 1)

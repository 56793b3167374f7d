"""Run one of the subpackage's queries in Spark and its SQL in DuckDB."""

import math
from collections import Counter
from pathlib import Path

import duckdb

from faultline.llm.queries import ORACLES, QUERIES


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, name, sf_dir):
    frame = QUERIES[name](spark, str(sf_dir))
    got = multiset(frame.columns, frame.collect())
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        inside = f"{file}/*.parquet" if file.is_dir() else file
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{inside}'")
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = multiset(names, cursor.fetchall())
    assert sorted(names) == sorted(frame.columns), (names, frame.columns)
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    return sum(got.values())

"""Run a query in Spark and in DuckDB, and compare rows as multisets."""

import math
from collections import Counter
from pathlib import Path

import duckdb

from faultline.catalog.oracles import ORACLES
from faultline.catalog.queries import QUERIES


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, name, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    got = multiset(frame.columns, frame.collect())
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    kinds = dict(zip(names, (str(d[1]) for d in cursor.description)))
    want = multiset(names, cursor.fetchall())
    assert sorted(names) == sorted(frame.columns), (names, frame.columns)
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in frame.dtypes:
        assert kinds[column] == pairs.get(kind, kind), (column, kind, kinds[column])
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    return sum(got.values())

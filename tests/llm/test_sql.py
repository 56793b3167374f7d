"""Every query of the subpackage that SQL expresses, against DuckDB: driver tables and a table of edge cases."""

import os

import pytest

from faultline.llm.queries import ORACLES, QUERIES
from edge_tables import write_edge_documents
from sql_oracle import compare

DATA = os.environ.get("FAULTLINE_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(spark, name, DATA) > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql_on_edge_cases(spark, name, tmp_path):
    write_edge_documents(spark, tmp_path)
    assert compare(spark, name, tmp_path) > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_empty_tables(spark, name, tmp_path):
    write_edge_documents(spark, tmp_path, rows=False)
    assert compare(spark, name, tmp_path) == 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

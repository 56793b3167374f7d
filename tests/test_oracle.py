"""Every SQL-expressible query against DuckDB."""

import os

import pytest

from faultline.catalog.oracles import ORACLES
from faultline.catalog.queries import QUERIES
from oracle import compare

DATA = os.environ.get("FAULTLINE_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(spark, name, DATA) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

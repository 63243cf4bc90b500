"""Every registered query against its DuckDB text on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from cargolens.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    difference, rows = compare(con, QUERIES[name](spark, SF_DIR), ORACLES[name])
    assert difference is None
    assert rows > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1

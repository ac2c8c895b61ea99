"""Every registered query with SQL agrees with it, value by value."""

import os
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points

FOLDER = os.environ.get("CLIENTELA_TEST_DATA", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, name):
    assert differences(QUERIES[name](spark, FOLDER), sql, ORACLES[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

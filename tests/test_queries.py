"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_points
from cartloom.workload import ORACLES, QUERIES
from tests.compare import oracle_connection, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(oracle, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

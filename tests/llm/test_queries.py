"""Queries with SQL against DuckDB on the small tables, the others for rows and columns."""

import pytest

from cartloom.llm import ORACLES, QUERIES
from tests.compare import oracle_connection, spark_rows, sql_rows
from tests.llm.shared import SF_DIR

PER_TABLE = {"documents": 200, "pages": 50}


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, oracle, name):
    columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(oracle, ORACLES[name])
    assert columns == expected_columns
    assert found == expected


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))

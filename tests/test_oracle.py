"""Every registered query against its SQL in another engine."""

import os

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import oracle_connection, spark_rows, sql_rows
from ordervane import checks

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(checks.QUERIES) <= set(queries())
    assert set(checks.QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert spark_rows(queries()[name](spark, FOLDER)) == sql_rows(connection, oracle_sql()[name])


def test_entry(spark):
    assert entry(spark).count() == 5

"""Every query against its SQL twin."""

import pytest

import __spark_entry__
from oracle import compare, sql_connection
from tidemark.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return sql_connection(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), SQL[name], connection) > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 5

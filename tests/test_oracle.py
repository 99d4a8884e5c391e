"""Every registered query against its SQL on the same tables."""

import pytest

from logloom.oracle import ORACLE_SQL
from logloom.registry import QUERIES
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)

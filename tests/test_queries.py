"""Every registered query against its SQL on whole tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from playbeat.plans.catalog import QUERIES
from playbeat.plans.oracle import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 75

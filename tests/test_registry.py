"""Every registered query equals its SQL on the given tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from registry.oracles import ORACLES
from registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name], con) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0

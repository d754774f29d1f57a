import pytest

from __spark_entry__ import entry, oracle_sql, queries
from martloom.oracle import ORACLES
from martloom.workloads import QUERIES

from .compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    """The corpus queries, which come on top, have tests of their own."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_entry(spark):
    assert entry(spark).count() == 10

"""Each corpus query against its SQL twin at the smallest scale."""

import pytest

from martloom.llm.queries import ORACLES
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None

"""Every registered query against its SQL on the small tables."""

import os

import pytest

from __spark_entry__ import entry
from midyear.catalog import ORACLES, QUERIES
from oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    n, problems = compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert not problems


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0

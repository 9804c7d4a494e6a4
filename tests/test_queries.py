"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from suite.check import compare, connect
from suite.oracles import ORACLES
from suite.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["content_type", "scrape_status", "n"]
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())

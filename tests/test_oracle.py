"""Every registered query against its SQL equivalent."""

import os

import pytest

from __spark_entry__ import entry
from stockweek.testbed.compare import compare, connect
from stockweek.testbed.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    found = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert found.same, found.detail


def test_entry(spark):
    assert entry(spark).count() > 0
    assert spark.catalog.currentDatabase() == "default"

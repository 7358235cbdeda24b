"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from catalog.all import ORACLES, QUERIES
from tools.check_oracles import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note

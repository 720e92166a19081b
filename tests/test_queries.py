"""Every registered query against its comparison SQL on the smallest tables."""

import os

import pytest

from conformance import compare, connect
from wardline.plans import catalog

FOLDER = os.environ.get("WARDLINE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) == ""


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as driver

    out = driver.entry(spark)
    assert out.count() > 0 and "event_id" in out.columns

"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import compare, connect
from tidemark.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_of_the_layers_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note

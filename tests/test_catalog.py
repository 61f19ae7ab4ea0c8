"""Registered queries against their SQL in a second engine."""

from pathlib import Path

import pytest
from check import compare, connect

import __spark_entry__ as spark_entry
from catalog.oracle import oracle_sql
from catalog.queries import queries

SF_DIR = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(
    not Path(SF_DIR).exists(), reason="driver tables not present"
)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()
    assert queries().keys() <= spark_entry.queries().keys()


@needs_data
def test_entry(spark):
    assert spark_entry.entry(spark).count() == 4


@needs_data
@pytest.mark.parametrize("name", queries())
def test_query_matches_sql(spark, duck, name):
    # The smallest tables have no region-day with more than 24 readings.
    empty = name == "coverage_check"
    assert not compare(spark, duck, name, SF_DIR, allow_empty=empty)

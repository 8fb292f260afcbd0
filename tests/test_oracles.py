"""Every query against its SQL; ``TEST_SF_DIR`` picks the data, the smallest by default."""

import os

import pytest

import __spark_entry__ as entry
import checks
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(checks.ORACLES)

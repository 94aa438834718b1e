"""Every registered query against its SQL twin, on whole tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    sql = entry.oracle_sql()[name]
    assert difference(spark, duck, entry.queries()[name], sql, SF_DIR) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0

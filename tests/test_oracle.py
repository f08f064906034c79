"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from crowdpulse.plans.queries import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    query, sql = entry_module.queries()[name], entry_module.oracle_sql()[name]
    same, detail = compare(spark, con, query, sql, SF_DIR)
    assert same, detail


def test_entry_gives_ten_countries(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 10
    assert [row.count_users for row in rows] == sorted((r.count_users for r in rows), reverse=True)

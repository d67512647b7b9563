"""Every query with a SQL counterpart, compared on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_entry_runs(spark):
    assert entry(spark).count() == 150


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())

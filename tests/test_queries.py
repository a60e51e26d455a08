"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from shopgauge.plans import oracles, registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_entry_gives_days(spark):
    assert entry.entry(spark).count() > 0

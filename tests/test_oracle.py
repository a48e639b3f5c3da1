"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as driver
from tripstar.catalog.registry import all_checks, all_queries

QUERIES = all_queries()
CHECKS = all_checks()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert len(QUERIES) == 130
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(driver.queries())
    assert set(CHECKS) <= set(driver.oracle_sql())


def test_entry_runs(spark):
    result = driver.entry(spark)
    assert result.count() > 0
    assert "trips_mom_growth" in result.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    assert differences(duck, CHECKS[name], QUERIES[name](spark, sf_dir)) == []

"""Every registered query equals its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from corpuslake.plans.queries import QUERIES
from tests import check_oracle

PAGED = {"articles_page"}  # the page lies beyond the smallest data set


@pytest.fixture(scope="module")
def con(sf):
    return check_oracle.connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    problem = check_oracle.compare(spark, con, name, sf)
    assert problem is None or (problem == "no rows" and name in PAGED), problem


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Every query with an SQL check gives the same rows as DuckDB on whole tables."""

import pytest

from corpusloom.plans import catalog
from corpusloom.plans.check import connect, difference

catalog.load()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, con, sf, name):
    assert difference(spark, con, sf, name) is None

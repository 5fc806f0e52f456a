"""Every query with SQL against DuckDB on the smallest tables; the others give rows."""

import pytest

from compare import same, views
from millrace import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, con, name):
    same(catalog.QUERIES[name](spark, SF), con, catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 95
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query against its DuckDB text on the smallest tables (the driver's gate runs sf0.01)."""

import pytest

from conftest import SF_SMALL
from streamguard.plans import catalog
from streamguard.plans.check import compare, duckdb_connection

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name)
    assert r["status"] in ("ok", "no-oracle"), r


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    q = E.queries()
    o = E.oracle_sql()
    assert set(o) <= set(q)

"""Every registered analysis with oracle SQL must equal DuckDB on the driver tables;
the rest must run and return rows with a stable schema."""

import pytest

from genoframe.plans.registry import load_all
from genoframe.plans.verify import compare

CATALOG = load_all()
WITH_SQL = sorted(k for k, (_, sql) in CATALOG.items() if sql is not None)
NO_SQL = sorted(k for k, (_, sql) in CATALOG.items() if sql is None)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, sf, con, name):
    fn, sql = CATALOG[name]
    ok, msg = compare(spark, name, sf, fn, sql, con)
    assert ok, msg


@pytest.mark.parametrize("name", NO_SQL)
def test_runs(spark, sf, name):
    fn, _ = CATALOG[name]
    df = fn(spark, sf)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q = e.queries()
    o = e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 150

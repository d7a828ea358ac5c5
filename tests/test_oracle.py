"""Every key with oracle SQL equals DuckDB on the same tables; the others run."""

import os

import pytest

from venuelens.plans.bindings import ORACLE_SQL, QUERIES

from .oracle_util import compare, duck

# sf0.001 by default (fast); VENUELENS_ORACLE_SF=/root/testdata/sf0.01 runs the driver's scale
SF = os.environ.get("VENUELENS_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, con, key):
    r = compare(spark, con, key, QUERIES[key], ORACLE_SQL[key], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_keys_run(spark, key):
    assert QUERIES[key](spark, SF).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

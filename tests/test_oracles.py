"""Every query of the engine against its SQL, and the contract's functions."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog
from tessera.session import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return round(float(v), 6) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_oracle(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(cols).collect()), key=str)
    cursor = oracle.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs_without_oracle(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.QUERIES["filter_compare"](spark, SF)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull" in plan and "GreaterThanOrEqual(o_totalprice,100000.0)" in plan
    plan = catalog.QUERIES["scan_project"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    plan = catalog.QUERIES["order_limit"](spark, SF)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan

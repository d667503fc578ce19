"""Every registered query against its SQL on the smallest tables, and the driver's contract."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from hexsite.plans import catalogue
from hexsite.plans.projections import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.queries()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1


def test_scans_are_pruned(spark):
    plan = catalogue.queries()["flt2_supply_mask"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan
    assert "c_name" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["jn8_range_self_join", "jn10_exists_within", "jn29_coverage", "jn13_point_in_polygon", "jn7_spatial_match"])
def test_no_nested_loops(spark, name):
    plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan

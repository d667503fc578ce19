"""The SQL of the queries that have one, on the small tables."""

import os

import duckdb
import pytest

from hexsite.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def plain(v):
    return round(v, 6) if isinstance(v, float) else list(map(plain, v)) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    got = sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert got == sorted((tuple(plain(v) for v in r) for r in want), key=repr)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"op1_chat_formatting"}))
def test_every_row_has_its_result(spark, name):
    table, key = ("pages", "page_id") if name in ("op4_warc_zstd", "op10_html_extraction") else ("documents", "doc_id")
    want = sorted(r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in queries.queries()[name](spark, DATA).select(key).collect()) == want

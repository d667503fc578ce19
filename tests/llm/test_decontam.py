"""Decontamination against a search for every window."""

import hashlib
import re

import pytest

from hexsite.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, window=10):
    out = []
    for i, t in rows:
        w, hit, own = fold(t), set(), set()
        for item, text in items:
            x = fold(text)
            for k in range(max(1, len(x) - window + 1) if x else 0):
                p = x[k : k + window]
                for s in range(len(w) - len(p) + 1):
                    if w[s : s + len(p)] == p:
                        hit |= set(range(s, s + len(p)))
                        own.add(str(item) if item is not None else "null")
        out.append((i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark, texts):
    long = texts[12][1]
    items = [(1, texts[4][1][:300]), (10, texts[7][1].upper()), (2, "one, TWO!"), (3, None), (4, "..."), (5, "never found in any of these documents at all whatever"), (10, "café — naïve Ünï"), (None, "two"), (6, "wholly other words " + " ".join((texts[9][1] or "").split()[50:75])), (7, long)]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_windows(docs, texts, benchmark):
    items, table = benchmark
    got = sorted((tuple(r) for r in decontam.op5(docs, table).collect()), key=str)
    assert got == brute(texts, items)
    parts = decontam.scan(docs, table, keep=["doc_id"], most_bytes=100)  # more items than one automaton may hold
    assert sorted((r["keep"]["doc_id"] or -1, r["n_hit"], r["items"]) for r in parts.collect()) == sorted((r["keep"]["doc_id"] or -1, r["n_hit"], r["items"]) for r in decontam.scan(docs, table, keep=["doc_id"]).collect())


def test_spans_are_of_the_original(spark, benchmark):
    _, table = benchmark
    text = "é—é One,\tTWO; end. one  two"
    row = decontam.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), table).first()
    assert [text[s["begin"] : s["end"]] for s in row["spans"]] == ["One,\tTWO", "one  two"]


def test_clean_documents_stay(docs, texts, benchmark):
    items, table = benchmark
    stay = decontam.decontaminated(docs, table)
    assert stay.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted(str(r[0]) for r in brute(texts, items) if not r[-1])
    assert decontam.decontaminated(docs, table.limit(0)).count() == docs.count()
    assert decontam.op5(docs.limit(0), table).count() == 0


def test_pieces_and_parts_against_a_search(spark, monkeypatch):
    """Random items of few words, so that blocks repeat and overlap; items in pieces; many parts; every window length."""
    import random

    draw = random.Random(3)
    line = lambda n, k: " ".join(f"w{draw.randrange(k)}" for _ in range(n))
    items = [(k, line(draw.choice([3, 9, 10, 11, 14, 25, 80]), 3 if k % 2 else 40)) for k in range(40)] + [(7, "w1 w2"), (None, line(12, 3)), ("null", line(12, 3))]
    rows = [(k, line(150, 3 if k % 2 else 40)) for k in range(30)] + [(100 + k, line(30, 40) + " " + items[k][1] + " " + line(5, 40)) for k in range(40)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(None if i is None else str(i), t) for i, t in items], "item_id string, text string")
    monkeypatch.setattr(decontam, "PIECE", 30)
    for window, most in ((10, 3 << 20), (10, 200), (1, 300), (2, 3 << 20), (7, 500)):
        got = sorted((r["keep"]["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in decontam.scan(docs, table, keep=["doc_id"], window=window, most_bytes=most).collect())
        want = []
        for i, t in rows:
            w, hit, own = fold(t), set(), set()
            where = {}
            for s in range(len(w)):
                for n in range(1, window + 1):
                    where.setdefault(tuple(w[s : s + n]), set()).add(s)
            for item, text in items:
                x = fold(text)
                for k in range(max(1, len(x) - window + 1)):
                    p = tuple(x[k : k + window])
                    for s in where.get(p, ()):
                        if s + len(p) <= len(w):
                            hit |= set(range(s, s + len(p)))
                            own.add(item)
            want.append((i, len(w), len(hit), len(own)))
        assert got == sorted(want), (window, most)


def test_nodes_are_bounded_by_bytes():
    import random

    draw = random.Random(4)
    pieces = [(str(k), " ".join(f"w{draw.randrange(10**6)}" for _ in range(200)).encode(), True) for k in range(200)]
    s = decontam.Scanner(pieces, 10)
    assert s.machine.get_stats()["nodes_count"] < 1.3 * sum(len(b) for _, b, _ in pieces)


def test_sql(spark):
    """The query's SQL on the small tables."""
    import os

    import duckdb

    from hexsite.llm import queries

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test data here")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = queries.op5_benchmark_decontamination(spark, data)
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({decontam.ORACLE_SQL})").fetchall())

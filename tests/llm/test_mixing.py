"""Mixing: targets, systematic sampling and its invariants."""

import math
import re

import pytest

from hexsite.llm import mixing


def fill(sizes):
    """Targets by sharing excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_sizes_targets_and_copies(docs, texts):
    rows = mixing.mixed(docs).collect()
    want = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts)
    assert sorted(r["size"] for r in rows) == want
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = {}
    for (i, t), s in zip(texts, [r["source"] for r in docs.collect()], strict=True):
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = fill(sizes)
    for r in rows:
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        if r["doc_id"] is not None and r["doc_id"] != 11:
            assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mixed(docs).collect()), key=str)
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mixed(docs, cell_rows=2).collect()))
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_sums_come_near_targets(spark):
    import random

    draw = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(draw.randrange(1, 60))), f"s{min(draw.randrange(9), 5)}") for i in range(4000)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source_size", "target").sum("taken", "copies").collect()
    assert len(got) == 6
    for r in got:
        assert abs(r["sum(taken)"] - r["target"]) < 0.03 * r["target"] + 60
    assert math.isclose(sum(r["target"] for r in got), 1.5 * sum(r["source_size"] for r in got))


def test_mixture_repeats_rows(docs):
    copies = {}
    for r in mixing.mixed(docs).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_native_plan(docs):
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

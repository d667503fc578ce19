"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from hexsite.llm import jaccard
from hexsite.llm._shared import words


def brute(rows, n=5):
    sets = [{tuple(w[i : i + min(n, len(w))]) for i in range(max(1, len(w) - n + 1))} if (w := words((t or "").encode())) else set() for _, t in rows]
    near = [[i != j and bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *[label[j] for j in range(len(rows)) if near[i][j]]]) for i in range(len(rows))]
    ids = {k: min((rows[i][0] for i in range(len(rows)) if label[i] == k and rows[i][0] is not None), default=None) for k in set(label)}
    return sorted(((rows[i][0], ids[label[i]], sum(near[i])) for i in range(len(rows))), key=str)


def run(df):
    return sorted((tuple(r) for r in jaccard.op2(df).collect()), key=str)


def test_all_links_and_classes(docs, texts):
    assert run(docs) == brute(texts)


def test_groups_of_near_copies(spark, monkeypatch):
    draw = random.Random(2)
    rows = []
    for g in range(3):
        base = [f"w{draw.randrange(500)}" for _ in range(150)]
        for _ in range(25):
            own = list(base)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(150)] = f"z{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert run(df) == want
    # groups are salted and components are cut into blocks: nothing changes
    monkeypatch.setattr(jaccard, "GROUP", 7)
    monkeypatch.setattr(jaccard, "BLOCK", 900)
    assert run(df) == want
    monkeypatch.setattr(jaccard, "BLOCK", 10**6)
    monkeypatch.setattr(jaccard, "NODES", 4)
    assert run(df) == want


def test_sizes_far_apart_in_one_component(spark, monkeypatch):
    """A chain of growing texts: neighbours are linked, the ends differ in size by a factor of ten."""
    draw = random.Random(8)
    line = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    rows = [(k, " ".join(line[: int(40 * 1.12**k)])) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert run(df) == want
    monkeypatch.setattr(jaccard, "NODES", 2)
    assert run(df) == want


def test_sets_too_small_for_a_near_one(spark):
    rows = [(1, "a b c"), (2, "a b c"), (3, "a b c d e f g"), (4, "a b c d e f g h"), (5, "a b c d e f g h i"), (6, "a")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_many_short_near_copies_stay_within_memory():
    """A block of the most nodes, of sets of 20: the comparison's arrays are bounded by nodes, not by shingles alone."""
    import tracemalloc

    draw = np.random.default_rng(9)
    base = draw.integers(0, 1 << 63, 20, dtype=np.uint64)
    sets = []
    for _ in range(2 * jaccard.NODES):
        own = base.copy()
        own[draw.integers(20)] = draw.integers(0, 1 << 63, dtype=np.uint64)
        sets.append(np.unique(own))
    tracemalloc.start()
    near = jaccard.linked(sets[: jaccard.NODES], sets[jaccard.NODES :], (4, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20
    for i, j in draw.integers(0, jaccard.NODES, (300, 2)):
        a, b = set(sets[i].tolist()), set(sets[jaccard.NODES + j].tolist())
        assert near[i, j] == (5 * len(a & b) >= 4 * len(a | b))


def test_empty_table_and_filter(spark, docs, texts):
    assert run(docs.limit(0)) == []
    stay = jaccard.deduplicated(docs)
    assert stay.columns == docs.columns
    want = {i for i, c, _ in brute(texts) if i == c}
    assert sorted(r["doc_id"] for r in stay.collect() if r["doc_id"] is not None) == sorted(x for x in want if x is not None)


def test_depths_keep_the_recall():
    """Simulated: a pair that agrees in each value with a chance of 0.8 is met, though prefixes are shortened by matches."""
    draw = np.random.default_rng(1)
    agree = draw.random((200_000, jaccard.TREES, jaccard.DEEPEST)) < 0.8
    shared = np.logical_and.accumulate(agree, axis=2).sum(axis=2)
    for recall in (0.9, 0.99, 0.999):
        shortest, depth = jaccard.depths(0.8, recall)
        assert jaccard.missed(0.8, shortest, depth) <= 1 - recall
        assert all(a >= b for a, b in zip(depth, depth[1:]))
        looked = np.array(depth)[(shared >= shortest).sum(axis=1)]
        assert (shared.max(axis=1) >= looked).mean() >= recall - 3e-4
    assert len(set(jaccard.depths(0.8, 0.99)[1])) > 1  # not one depth for all


def test_walk_meets_at_the_prefix_asked_for():
    labels = np.array([[1, 1, 1, 1, 1, 1, 1, 1], [1, 1, 1, 1, 1, 1, 1, 1], [1, 1, 1, 1, 1, 1, 2, 2], [1, 1, 1, 1, 1, 1, 3, 3]], np.uint16)
    briefs = np.zeros((4, jaccard.VALUES), np.uint8)
    assert jaccard.common(labels).tolist() == [8, 6, 6]
    assert len(jaccard.walk(labels, np.array([8, 8, 8, 8]), briefs, 0.6)) == 1
    assert len(jaccard.walk(labels, np.array([8, 8, 8, 6]), briefs, 0.6)) == 3  # one that is looked up at 6 meets all


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        a = draw.integers(0, 1 << 63, 2000, dtype=np.uint64)
        k = int(2000 * 2 * share / (1 + share))
        b = np.concatenate([a[:k], draw.integers(0, 1 << 63, 2000 - k, dtype=np.uint64)])
        s = jaccard.signatures([np.unique(a), np.unique(b)])
        assert (s[0] == s[1]).mean() == pytest.approx(share, abs=0.15)


def test_spanning_connects_what_agrees():
    draw = np.random.default_rng(4)
    briefs = draw.integers(0, 3, (60, jaccard.VALUES)).astype(np.uint8)
    briefs[10:30] = briefs[10]
    briefs[10:30, :20] = draw.integers(0, 99, (20, 20))
    ties = jaccard.spanning(briefs, 0.6)
    assert len(ties) == 19
    assert {x for t in ties for x in t} == set(range(10, 30))


def test_many_rows_without_an_id(spark):
    """Rows are found again by id and text, so those of one id don't meet each other; repeats are held once."""
    draw = random.Random(12)
    base = [" ".join(f"w{draw.randrange(5000)}" for _ in range(60)) for _ in range(40)]
    rows = [(None, t) for t in base] + [(None, t + " more") for t in base] + [(None, base[0])] * 30 + [(7, base[1])] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)

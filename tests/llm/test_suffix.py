"""Suffix-array deduplication against a table of all windows."""

import random

import numpy as np

from hexsite.llm import suffix


def test_suffix_arrays():
    draw = np.random.default_rng(1)
    for k in range(60):
        n = int(draw.integers(1, 300))
        text = (draw.integers(0, 3, n) + (0, 97, 253)[k % 3]).astype(np.uint8)
        words = suffix.words_at(text)
        order = suffix.suffix_array(text, words)
        assert sorted(order.tolist()) == list(range(n))
        raw = text.tobytes()
        keys = [raw[i : i + suffix.LENGTH].ljust(suffix.LENGTH, b"\0") for i in order]
        assert keys == sorted(keys)
        shared = suffix.common_prefixes(words, order)
        assert shared[0] == 0
        for a, b, m in zip(keys, keys[1:], shared[1:], strict=False):
            assert m == next((i for i in range(suffix.LENGTH) if a[i] != b[i]), suffix.LENGTH)
    assert len(suffix.suffix_array(np.zeros(0, np.uint8), suffix.words_at(np.zeros(0, np.uint8)))) == 0


def test_documents(docs, texts):
    got = sorted((tuple(r) for r in suffix.op9(docs).collect()), key=str)
    assert got == sorted(suffix.brute_force(texts).values(), key=str)
    assert suffix.op9(docs.limit(0)).count() == 0


def test_passages_over_chunks(spark, monkeypatch):
    draw = random.Random(7)
    passage = ["".join(draw.choice("abcd ") for _ in range(draw.choice([49, 50, 51, 80, 400]))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [draw.choice(passage) if draw.random() < 0.5 else "".join(draw.choice("abcdefghij ") for _ in range(draw.randrange(120))) for _ in range(draw.randrange(5))]
        rows.append((draw.choice([i, i, i, i // 2]), "".join(parts)))
    rows += [(500, "z" * 700), (501, "z" * 60), (502, "ab" * 300), (503, "b" + "ab" * 40), (504, "é" * 60), (505, "é" * 60), (506, None)]
    monkeypatch.setattr(suffix, "CHUNK", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in suffix.op9(df).collect()), key=str) == sorted(suffix.brute_force(rows).values(), key=str)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix.without_repeats(df.filter("doc_id >= 500")).collect()}
    assert kept[500] == b"z" * 700 and kept[501] == b"" and kept[505] == b""


def test_a_key_in_very_many_segments(monkeypatch):
    draw = np.random.default_rng(3)
    base = [draw.integers(97, 100, 70).astype(np.uint8) for _ in range(4)]
    segments, docs = [], []
    for i in range(300):
        a = int(draw.integers(0, 15))
        segments.append(base[i % 4][a : a + int(draw.integers(50, 71 - a))])
        docs.append(int(draw.integers(0, 50)))
    least = {}
    for s, d in zip(segments, docs, strict=True):
        for k in range(len(s) - 49):
            w = s[k : k + 50].tobytes()
            least[w] = min(least.get(w, 99), d)
    want = {(i, k) for i, (s, d) in enumerate(zip(segments, docs, strict=True)) for k in range(len(s) - 49) if least[s[k : k + 50].tobytes()] < d}
    body = suffix.pack(np.arange(300, dtype=np.uint32), np.array(docs), np.array([len(s) for s in segments], np.uint8), np.concatenate(segments), np.zeros(300, np.uint32))
    for most in (2000, 10**9):
        monkeypatch.setattr(suffix, "ARRAY", most)
        got = set()
        for out in suffix._fourth_step(iter([suffix._message([(0, "c", "bytes", body)])])):
            for raw in out.column(3).to_pylist():
                for i, a, b in zip(*suffix.unpack(raw), strict=True):
                    got |= {(int(i), k) for k in range(int(a), int(b))}
        assert got == want


def test_pack_round_trip():
    arrays = [np.arange(5), np.zeros(0, np.uint32), np.array([1, 255], np.uint8), np.array([-(1 << 63), 7])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(suffix.unpack(suffix.pack(*arrays)), arrays, strict=True))


def test_digests_decide_nothing(spark, monkeypatch):
    """With digests and marks that are all alike, only the bytes are left to tell segments apart."""
    draw = random.Random(11)
    passage = ["".join(draw.choice("abc ") for _ in range(draw.choice([50, 90]))) for _ in range(5)]
    rows = [(i, "".join(draw.choice(passage)[draw.randrange(4) :] for _ in range(4))) for i in range(40)]
    texts, ids = [t.encode() for _, t in rows], np.arange(40)
    s = suffix.Segments(texts, ids)
    s.digest[:] = 7
    s.key[:] = 5 << 40
    order, first, _, _ = s.distinct(1)
    of = np.cumsum(np.isin(np.arange(len(order)), first)) - 1
    raw = b"".join(texts)
    piece = lambda k: raw[s.start[k] : s.start[k] + s.windows[k] + suffix.LENGTH - 1]
    assert all(piece(k) == piece(order[first[g]]) for k, g in zip(order, of, strict=True))
    monkeypatch.setattr(suffix, "_marks", lambda text, first, length: np.zeros(len(first), np.uint64))
    body = suffix.pack(np.arange(len(s.start), dtype=np.uint32), s.id, (s.windows + 49).astype(np.uint8), np.concatenate([np.frombuffer(piece(k), np.uint8) for k in range(len(s.start))]), np.zeros(len(s.start), np.uint32))
    least, got = {}, set()
    for k in range(len(s.start)):
        for j in range(int(s.windows[k])):
            w = piece(k)[j : j + 50]
            least[w] = min(least.get(w, 99), int(s.id[k]))
    for out in suffix._fourth_step(iter([suffix._message([(0, "c", "bytes", body)])])):
        for packed in out.column(3).to_pylist():
            for i, a, b in zip(*suffix.unpack(packed), strict=True):
                got |= {(int(i), k) for k in range(int(a), int(b))}
    assert got == {(k, j) for k in range(len(s.start)) for j in range(int(s.windows[k])) if least[piece(k)[j : j + 50]] < s.id[k]}


def test_a_text_larger_than_a_chunk(spark, monkeypatch):
    draw = random.Random(12)
    big = "".join(draw.choice("abcdefghij klmnop") for _ in range(60_000))
    rows = [(1, big), (2, "x" + big[100:5000] + "y"), (3, big[:40] + "|" + big[7000:7049] + "|" + big[7000:7050])]
    monkeypatch.setattr(suffix, "CHUNK", 3000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix.op9(df).collect())) == sorted(suffix.brute_force(rows).values())

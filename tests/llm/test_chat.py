"""Chat formatting against a comparison of whole conversations."""

import random

from hexsite.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos int"


def brute(rows):
    import hashlib

    def mark(x):
        return "-" if x is None else "=" + x

    turns = {}
    for conv, turn, role, text in {tuple(r[:4]) for r in rows}:
        turns.setdefault(conv, []).append((turn, role, text))
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.md5((mark(t[1]) + "\x1f" + mark(t[2])).encode()).hexdigest())
    whole = {c: tuple(t[1:] for t in sorted(ts, key=key)) for c, ts in turns.items()}
    out = {}
    for conv, own in whole.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in whole.values()):
            continue
        same = [c for c, o in whole.items() if o == own]
        if conv == min((c for c in same if c is not None), default=None):
            out[conv] = (len(own), len(same), "".join(f"<|im_start|>{'unknown' if r is None else r}\n{t or ''}<|im_end|>\n" for r, t in own))
    return out


def made():
    draw = random.Random(1)
    rows = []
    stems = [[("user", f"hello {i}"), ("assistant", "hi"), ("user", f"more {i}"), ("assistant", "yes")] for i in range(4)]
    for conv in range(40):
        stem = stems[draw.randrange(4)]
        n = draw.randrange(1, 6)
        turns = [*stem, ("user", f"end {draw.randrange(3)}")][:n]
        rows += [(conv, k, r, t, 0) for k, (r, t) in enumerate(turns)]
    rows += [(100, None, None, None, 0), (100, 0, "user", None, 1), (101, 0, "user", "x", 0), (101, 0, "user", "y", 0), (101, 0, "user", "y", 0), (102, 0, "", "", 0), (None, 0, "user", "only", 0), (103, 0, "user", "long " * 5000, 0)]
    return rows


def test_maximal_conversations(spark):
    rows = made()
    got = {r["conv_id"]: (r["n_turns"], r["n_logged"], r["text"]) for r in chat.op1(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert chat.op1(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_and_parts_change_nothing(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    rows = df.selectExpr("conv_id AS conv", "turn", "role", "text")
    from pyspark.sql import functions as F

    turns = rows.select("conv", "turn", chat._turn_hash(F.col("role"), F.col("text")).alias("hash")).distinct()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, chat.rolled(turns, 1024).collect()), key=key) == sorted(map(tuple, chat.rolled(turns, 2).collect()), key=key)
    parts = {}
    for r in sorted(chat.formatted(df, part_turns=2).collect(), key=lambda r: (r["conv_id"] or -1, r["part"])):
        assert r["text"].count("<|im_start|>") <= 2
        parts[r["conv_id"]] = parts.get(r["conv_id"], "") + r["text"]
    assert parts == {k: v[2] for k, v in brute(made()).items()}

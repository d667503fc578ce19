"""One row of each class stays, whatever the ids."""

import random

from hexsite.llm import jaccard


def test_null_and_equal_ids(spark):
    draw = random.Random(5)
    line = lambda: " ".join(f"w{draw.randrange(3000)}" for _ in range(80))
    near = lambda t: t.replace(t.split()[40], "changed", 1)
    a, b, c, d, e, f, g, h = (line() for _ in range(8))
    rows = [
        (None, a), (None, b), (None, c), (None, c), (None, near(c)),  # three classes without any id
        (1, d), (1, e),  # one id, different texts
        (2, f), (3, near(f)), (3, g),  # an id of a near copy and of a clean text
        (None, near(g)), (4, h), (4, h), (4, near(h)),  # copies under one id
        (None, None), (None, ""), (5, "..."), (5, "..."), (5, None),
    ]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, place int")
    got = [(r["doc_id"], r["text"]) for r in jaccard.deduplicated(df).collect()]
    fixed = [(None, a), (None, b), (1, d), (1, e), (2, f), (3, g), (None, None), (None, ""), (5, "..."), (5, None)]
    assert all(got.count(r) == 1 for r in fixed)
    assert sum(r in ((None, c), (None, near(c))) for r in got) == 1
    assert sum(r in ((4, h), (4, near(h))) for r in got) == 1
    assert len(got) == len(fixed) + 2

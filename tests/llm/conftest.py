import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): null, empty, wordless, short, copies, near copies, a very long one, repeated rows."""
    import random

    draw = random.Random(0)
    line = lambda n: " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))
    base, other = line(120), line(90)
    near = base.split()
    near[60] = "changed"
    rows = [(1, None), (2, ""), (3, "!!! ... ???"), (4, "one two"), (5, base), (6, base), (7, " ".join(near)), (8, other), (9, line(30) + "\n" + other + " tail"), (10, line(4000)), (11, "Ünï Çödé — naïve café " * 12), (11, "Ünï Çödé — naïve café " * 12), (12, "ONE two"), (None, other), (13, line(200))]
    return rows


@pytest.fixture
def docs(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"s{k % 3}" if k % 5 else None, k, "keep", "x") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, keep string, digest string")

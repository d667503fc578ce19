"""Language identification: the forward sum, held-out accuracy, defined results."""

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from hexsite.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.01"


def test_forward_sums_all_segmentations():
    v = langid.Vocabulary(PATH)
    p = np.random.default_rng(0).random((v.n, 2)) / 50
    p[-1] = langid.FLOOR

    def total(s, c):
        if not s:
            return 1.0
        out = 0.0
        for k in range(1, len(s) + 1):
            i = v.find.get(s[:k], -1)
            if i >= 0:
                out += p[i, c] * total(s[k:], c)
            elif k == 1:
                out += p[-1, c] * total(s[k:], c)
        return out

    strings = ["▁the", "▁übung", "▁a", "▁xq☃z", "☃", "ation"]
    got = np.exp(langid.log_probabilities(v, strings, p))
    assert got == pytest.approx(np.array([[total(s, c) for c in range(2)] for s in strings]))
    assert langid.parts_of("a".encode() * 60) == ["▁" + "a" * 23, "a" * 24, "a" * 13]


def test_words_of_ten_thousand_characters_are_summed_whole():
    """Against the sum in whole numbers (probabilities as fractions of 2**40), which neither cuts nor scales."""
    v = langid.Vocabulary(PATH)
    draw = np.random.default_rng(1)
    p = np.maximum(draw.random((v.n, 3)) / 50, 1e-6)
    p[:, 1] *= draw.random(v.n)
    whole = np.maximum((p * 2**40).astype(np.int64), 1)
    p = whole / 2**40
    letters = list("abcdefghinorst") + ["ü", "漢", "字", "☃"]
    strings = ["▁" + "".join(draw.choice(letters, n)) for n in (10, 24, 40, 333, 333, 10_000)]

    def exact(s, c):
        import math

        sums = [1]
        for j in range(1, len(s) + 1):
            total = 0
            for i in range(max(0, j - v.longest), j):
                k = v.find.get(s[i:j], -1)
                if k < 0 and i == j - 1:
                    k = v.n - 1
                if k >= 0:
                    total += sums[i - j] * int(whole[k, c]) << 40 * (j - i - 1)
            sums.append(total)
            del sums[: -v.longest - 1]
        n = sums[-1]
        shift = max(0, n.bit_length() - 60)
        return math.log(n >> shift) + (shift - 40 * len(s)) * math.log(2)

    want = np.array([[exact(s, c) for c in range(3)] for s in strings])
    assert langid.log_probabilities(v, strings, p) == pytest.approx(want, rel=1e-9)
    assert langid.scaled(v, strings, p, window=v.longest) == pytest.approx(want, rel=1e-9)
    assert langid.scaled(v, strings, p, window=1000) == pytest.approx(want, rel=1e-9)


def test_long_words_are_scored_once_and_not_kept():
    v = langid.Vocabulary(PATH)
    langs, p = langid.fit(v, {"x": Counter({"▁漢字": 9, "漢": 4, "字": 5}), "y": Counter({"▁かな": 9, "か": 4, "な": 4})})
    scorer = langid.Scorer(v, langs, p)
    texts = [("漢字" * 400).encode(), ("かな" * 400 + " かな").encode(), b"!!", ("0" * 70).encode()]
    names, scores = scorer.predict(texts)
    assert names == ["x", "y", "und", "und"] and scores[0] > 0.99
    assert all(len(w) <= langid.KEPT for w in scorer.row)


def test_ties_go_to_the_first_language():
    v = langid.Vocabulary(PATH)
    same = Counter({"▁the": 9, "▁cat": 5})
    langs, p = langid.fit(v, {"b": same, "a": same})
    assert langid.Scorer(v, langs, p).predict([b"the cat"]) == (["a"], [pytest.approx(0.5)])


def test_fitting_raises_the_likelihood():
    v = langid.Vocabulary(PATH)
    counts = {"x": Counter({"▁the": 9, "▁cat": 5, "▁sat": 3}), "y": Counter({"▁die": 9, "▁katze": 5, "▁saß": 3})}
    score = []
    for rounds in (1, 3):
        langs, p = langid.fit(v, counts, rounds, strength=1.0)
        logs = langid.log_probabilities(v, ["▁the", "▁katze"], p)
        score.append(logs[0, 0] + logs[1, 1])
        assert logs[0].argmax() == 0 and logs[1].argmax() == 1
    assert langs == ["x", "y"] and score[1] >= score[0]
    assert langid.fit(v, {})[0] == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.op8(docs, PATH).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 200 and np.mean(held) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)
    # what is held out doesn't teach
    from pyspark.sql import functions as F

    lied = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert "xx" not in langid.trained(lied, PATH)[0]


def test_defined_results(docs):
    got = {}
    for r in langid.op8(docs, PATH).collect():
        got[r["doc_id"]] = (r["lang_pred"], r["score"])
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[5][0] == "en"
    from pyspark.sql import functions as F

    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in langid.op8(unlabelled, PATH).collect()} == {("und", 0.0)}
    assert langid.op8(docs.limit(0), PATH).count() == 0
    stay = langid.known_language(docs, PATH)
    assert stay.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in stay.collect()} == {1, 2, 3}

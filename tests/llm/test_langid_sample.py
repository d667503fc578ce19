"""The fitting sample: every language is drawn, and a long text can't exceed the bound."""

import public_tokenizers

from hexsite.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_few_long_documents_are_learned_within_the_bound(spark, monkeypatch):
    rare = "zzyx qworv plimt " * 3000
    rows = [(k, "the cat sat on a mat and looked at the dog " * 4, "en") for k in range(400)] + [(1000 + k, rare, "qq") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    monkeypatch.setattr(langid, "fit", lambda vocabulary, counts: seen.update(counts) or (sorted(counts), None))
    langid.trained(docs, PATH, fit_bytes=2000)
    size = {k: sum(len(s.encode()) * n for s, n in c.items()) for k, c in seen.items()}
    assert set(size) == {"en", "qq"}
    assert 1000 < size["qq"] < 6000
    assert 1000 < size["en"] < 6000
    monkeypatch.undo()
    got = langid.identified(docs, langid.trained(docs, PATH, fit_bytes=2000), PATH).select("keep.lang", "lang_pred").distinct().collect()
    assert {tuple(r) for r in got} == {("en", "en"), ("qq", "qq")}


def test_beginning_keeps_whole_words():
    assert langid.beginning("one two three".encode(), 9) == b"one two"
    assert langid.beginning("éé".encode(), 3) == "é".encode()

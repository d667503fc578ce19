"""What the second round's findings on the pipeline were about: memory of the driver and of executors."""


def test_the_driver_gives_back_what_fitting_took(spark, monkeypatch):
    import public_tokenizers

    from hexsite.llm import langid

    order = []
    monkeypatch.setattr(langid, "fit", lambda vocabulary, counts: order.append("fit") or (sorted(counts), None))
    monkeypatch.setattr(langid, "give_back", lambda: order.append("give_back"))
    docs = spark.createDataFrame([(k, "the cat sat on a mat", "en") for k in range(8)], "doc_id long, text string, lang string")
    assert langid.trained(docs, public_tokenizers.path("piece_bpe_32k.model")) == (["en"], None)
    assert order == ["fit", "give_back"]


def test_the_pipeline_encodes_small_slabs(spark, monkeypatch):
    import corpus_pipeline
    from hexsite.llm import tokens

    asked = {}
    monkeypatch.setattr(tokens, "op6", lambda docs, tokenizer, **how: asked.update(how))
    corpus_pipeline.token_output(spark, None, "")
    assert asked["slab"] <= 2 << 20


def test_slabs_of_any_size_give_the_same_ids(spark):
    import public_tokenizers

    from hexsite.llm import tokens

    texts = ["", None, "one two  three", "four " * 50, " five", "six\nseven"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, small = (sorted(map(tuple, tokens.op6(docs, path, slab=n).collect())) for n in (4 << 20, 10))
    assert len(whole) == len(texts) and whole == small


def test_arrow_gives_back_what_it_has_freed(monkeypatch):
    from hexsite.llm import _shared

    real, called = _shared.pa.default_memory_pool(), []

    class Pool:
        def release_unused(self):
            called.append(real.release_unused())

    monkeypatch.setattr(_shared.pa, "default_memory_pool", Pool)
    _shared.give_back()
    assert called == [None]

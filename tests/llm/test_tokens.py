"""Token output: the library's ids, exact round trips, damage."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hexsite.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    library = Tokenizer.from_file(PATH)
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
    out, start = [], 0
    for i, x in ids:
        out.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    return out


def test_ids_come_back(docs, texts, tmp_path):
    key = lambda r: (r[1])
    assert sorted((tuple(r) for r in tokens.op6(docs, PATH).collect()), key=key) == expected(texts)
    folder = f"file://{tmp_path}/t"
    manifest = tokens.write_shards(docs, folder, PATH, shard_bytes=600)
    assert manifest.count() > 3
    assert sorted((tuple(r) for r in tokens.read_digests(manifest, folder).collect()), key=key) == expected(texts)
    assert tokens.read_shards(manifest, folder).filter("doc_id = 2").first()["ids"] == [2]
    assert tokens.op6(docs.limit(0), PATH).count() == 0


def test_pieces_are_the_library():
    odd = ["a  b", "a \n b", " x", "", "  ", "b\n \n c", "don't  x's", "a \n  b", "x\n \ny z", "a ", "tab\t b", "  b", "b  c", "e  f", "<|endoftext|> a", "a<|endoftext|>", "日本 語 テキスト", "x" * 5000 + " y", "\r\n a", "a\x1c b", "'s 't", "1 2 33"]
    for most in (10**6, 1):
        pieces = tokens.Pieces(PATH, most)
        for _ in range(2):
            got = pieces.encode([t.encode() for t in odd])
            assert [np.frombuffer(g, "<u2").tolist() for g in got] == [[*Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids, 2] for t in odd]


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    """Hashes of four values: nearly all pieces clash, and every text still has the library's ids."""
    plain = tokens.Pieces._hash
    monkeypatch.setattr(tokens.Pieces, "_hash", staticmethod(lambda *a: plain(*a) & np.uint64(3)))
    texts = ["the cat sat", "the dog ran off quickly and unbelievably far", "the cat sat", "", "a b", "cat the"]
    pieces = tokens.Pieces(PATH)
    for _ in range(2):
        got = pieces.encode([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [[*Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_rows_of_one_id_are_dealt_to_several_shards(spark, tmp_path):
    rows = [(None if k % 2 else 7, f"text number {k} " * 9) for k in range(400)]
    folder = f"file://{tmp_path}/r"
    manifest = tokens.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), folder, PATH, shard_bytes=1500)
    assert manifest.groupBy("part").count().count() > 4
    assert sorted((tuple(r) for r in tokens.read_digests(manifest, folder).collect()), key=lambda r: r[1]) == expected(rows)


@pytest.mark.parametrize("kind", ["flat", "skewed", "one"])
def test_coder(kind):
    draw = np.random.default_rng(1)
    n = tokens.LANES * tokens.STEPS * 3 + 77
    ids = {"flat": draw.integers(0, 50257, n), "skewed": draw.zipf(1.3, n) % 50257, "one": np.full(n, 7)}[kind].astype(np.uint32)
    u, c = np.unique(ids, return_counts=True)
    table = tokens.Table.of_counts(u, c)
    assert int(table.freq.sum()) == 1 << tokens.SCALE and int(table.freq.min()) >= 1
    table = tokens.Table.from_bytes(table.to_bytes())
    out = io.BytesIO()
    writer = tokens.ShardWriter(out, table)
    for a in range(0, n, 9999):
        writer.add(a, ids[a : a + 9999])
    writer.close()
    raw = out.getvalue()
    foot = tokens.shard_footer(raw)
    assert (tokens.shard_ids(raw, foot, table) == ids).all()
    # any block alone, from its checkpoint
    at, size, first, count, steps, crc = foot["blocks"][2]
    block = tokens.decode_blocks([raw[at : at + size]], steps, table)[0][:count]
    assert (block == ids[first : first + count]).all() and zlib.crc32(block.astype("<u4").tobytes()) == crc
    entropy = -(c / n * np.log2(c / n)).sum() * n / 8
    assert len(raw) < entropy * 1.06 + 60_000
    if kind != "one":
        broken = bytearray(raw)
        broken[foot["blocks"][1][0] + tokens.LANES * 8 + 5] ^= 1
        with pytest.raises((ValueError, IndexError)):
            tokens.shard_ids(bytes(broken), foot, table)
    with pytest.raises(ValueError):
        tokens.shard_footer(raw[:-20] + b"\0" * 20)

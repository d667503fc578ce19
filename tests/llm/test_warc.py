"""WARC archives: round trips, revisits and damage."""

import hashlib
import struct

import pytest

from hexsite.llm import warc

BIG = "<html>" + "content " * 40 + "</html>"


@pytest.fixture
def pages(spark):
    rows = [(5, "http://a/", BIG, "x"), (3, "http://b/\r\nX: y", BIG, "x"), (9, None, BIG, "x"), (1, "u", None, "x"), (2, "u", "", "x"), (7, "u", "short", "x"), (8, "u", "short", "x"), (11, "ü", "é\0" * 50000, "x"), (None, "n", BIG, "x"), (12, "u", "\r\n\r\n" * 40, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/warc"
    listed = warc.write_archives(pages, folder, archive_bytes=1000)
    got = {r["page_id"]: r for r in warc.read_archives(listed, folder, payloads=True).collect()}
    assert len(got) == 10
    for r in pages.collect():
        raw = (r["html"] or "").encode()
        g = got[r["page_id"]]
        assert (g["payload_bytes"], g["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        revisit = r["html"] == BIG and r["page_id"] != 3
        assert (g["record_type"], g["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert bytes(g["payload"]) == (b"" if revisit else raw)
    assert not [p for p in (tmp_path / "warc").iterdir() if p.name.startswith(".")]
    assert warc.op4(pages.limit(0)).count() == 0


def archive():
    records = [warc.record(i, f"http://x/{i}", f"<p>page {i} of many pages</p>".encode() * 9, None) for i in range(60)]
    return records, warc.archive(records, [r[-200:] for r in records])


def test_dictionary_leads_and_frames_hold_one_record():
    records, raw = archive()
    assert struct.unpack_from("<I", raw)[0] == warc.DICTIONARY
    assert list(warc.frames(raw)) == records


def test_damage_is_found():
    import zstandard

    records, raw = archive()
    with pytest.raises(warc.DamagedArchive):
        list(warc.frames(raw[:-2]))
    broken = bytearray(raw)
    broken[-9] ^= 0xFF
    with pytest.raises(warc.DamagedArchive):
        list(warc.frames(bytes(broken)))
    with pytest.raises(warc.DamagedArchive):
        list(warc.frames(raw[:20]))
    one = records[0]
    for bad in (one + records[1], one[:-1], one.replace(b"WARC/1.1", b"HTTP/1.1"), one.replace(b"page 0", b"page 1", 1), one.replace(b"WARC-Date", b"X-Date"), one.replace(b"Content-Length: ", b"Content-Length: 1", 1), one.replace(b"WARC-Type: response", b"WARC-Type: revisit"), b""):
        with pytest.raises(warc.DamagedArchive):
            warc.parse(bad)
    plain = zstandard.ZstdCompressor().compress(one)  # an archive without dictionary is read too
    assert list(warc.frames(plain)) == [one]


def test_few_samples_give_no_dictionary():
    assert list(warc.frames(warc.archive([warc.record(1, "u", b"", None)], []))) == [warc.record(1, "u", b"", None)]

"""Telephony audio: round trips, tables and ADPCM sample by sample."""

import hashlib
import zlib

import numpy as np
import pytest

from hexsite.llm import audio


def plain_wav(payload, kind):
    """The stored form, written out: header fields one by one."""
    num = lambda *fields: b"".join(int(v).to_bytes(n, "little") for v, n in fields)
    if kind == 17:  # 64 bytes hold 121 samples
        fmt = num((17, 2), (1, 2), (8000, 4), (8000 * 64 // 121, 4), (64, 2), (4, 2), (2, 2), (121, 2))
    else:
        fmt = num((kind, 2), (1, 2), (8000, 4), (8000, 4), (1, 2), (8, 2), (0, 2))
    body = b"WAVE" + b"fmt " + num((len(fmt), 4)) + fmt + b"data" + num((len(payload), 4)) + payload
    return b"RIFF" + num((len(body), 4)) + body


def test_features_are_of_what_is_stored(docs, texts):
    """Sample by sample, for each of the codings."""
    kinds = set()
    for r in audio.op3(docs.filter("doc_id IN (5, 7, 8, 10, 11, 13)")).distinct().collect():
        raw = next((t or "").encode() for i, t in texts if i == r["doc_id"])
        p = raw + b"\0" * (-len(raw) % 64)
        kind = (7, 6, 17)[zlib.crc32(p) % 3]
        kinds.add(kind)
        pcm = [x for block in audio.adpcm_decode(p).tolist() for x in block] if kind == 17 else [int((audio.ALAW_PCM if kind == 6 else audio.ULAW_PCM)[b]) for b in p]
        pairs = [(a + b) // 2 for a, b in zip(pcm[::2], (pcm[1:] if len(pcm) % 2 == 0 else [*pcm[1:], pcm[-1]])[::2])]
        crc = lambda x: zlib.crc32(np.array(x, "<i2").tobytes())
        want = {"n": len(pcm), "peak": max(map(abs, pcm)), "energy": sum(x * x for x in pcm), "crossings": sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:])), "pcm_crc32": crc(pcm), "rate": 4000, "n_resampled": len(pairs), "resampled_crc32": crc(pairs)}
        assert r["feature"] == ";".join(f"{k}={v}" for k, v in want.items())
    assert len(kinds) > 1


def test_codings_are_equal_for_equal_texts_and_all_used():
    payloads = [audio.padded(f"text {k}".encode()) for k in range(60)]
    assert {audio.kind_of(p) for p in payloads} == {audio.ULAW, audio.ALAW, audio.ADPCM}
    together = audio.decode_all([audio.wav(p, audio.kind_of(p), block=64) for p in payloads])
    for p, (rate, payload, pcm) in zip(payloads, together):
        assert payload == p and rate == 8000
        assert (audio.decode(audio.wav(p, audio.kind_of(p), block=64))[1] == pcm).all()


@pytest.mark.parametrize("wanted", [4000, 2000, 16000, 24000, 6000, 11025])
def test_rates(wanted):
    pcm = np.random.default_rng(2).integers(-32768, 32768, 997).astype(np.int16)
    got = audio.to_rate(pcm, 8000, wanted).tolist()
    if 8000 % wanted == 0:
        k = 8000 // wanted
        x = [*pcm.tolist(), *[int(pcm[-1])] * (-len(pcm) % k)]
        assert got == [sum(x[i : i + k]) // k for i in range(0, len(x), k)]
    else:
        at = [i * 8000 / wanted for i in range(len(got))]
        assert got == pytest.approx(np.interp(at, np.arange(len(pcm)), pcm.astype(float)), abs=1.01)


def test_payload_comes_back(docs, texts):
    got = sorted((tuple(r) for r in audio.op3(docs).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256").collect()), key=str)
    want = []
    for i, t in texts:
        raw = (t or "").encode()
        p = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        m = plain_wav(p, (7, 6, 17)[zlib.crc32(p) % 3])
        want.append((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest()))
    assert got == sorted(want, key=str)
    assert audio.op3(docs.limit(0)).count() == 0


def test_tables():
    assert audio.ULAW_PCM[[0x00, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0]
    assert audio.ALAW_PCM[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    assert len(set(audio.ALAW_PCM.tolist())) == 256
    assert (np.diff(audio.ULAW_PCM[0x80:].astype(int)) <= 0).all()


def test_adpcm_sample_by_sample():
    payload = np.random.default_rng(0).integers(0, 256, 64 * 40).astype(np.uint8).tobytes()

    def one(block):
        s, i = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
        out = [s]
        for byte in block[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(audio.STEPS[i])
                change = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                s = max(-32768, min(32767, s - change if code & 8 else s + change))
                i = max(0, min(88, i + int(audio.MOVES[code & 7])))
                out.append(s)
        return out

    assert audio.adpcm_decode(payload).tolist() == [one(payload[k : k + 64]) for k in range(0, len(payload), 64)]
    rate, pcm = audio.decode(audio.wav(payload, audio.ADPCM, block=64))
    assert rate == 8000 and len(pcm) == 40 * 121


def test_resampled_pcm_is_stored(docs):
    row = audio.media_column(docs.filter("doc_id = 5"), pcm=2).first()
    rate, pcm = audio.decode(row["pcm"])
    _, narrow = audio.decode(row["media"])
    assert rate == 16000
    assert (pcm[::2] == narrow).all()


@pytest.mark.parametrize("bad", [b"", b"RIFF", audio.wav(b"\0" * 64, audio.ULAW)[:-3], audio.wav(b"\0" * 64, audio.ULAW)[:40]])
def test_damaged_media(bad):
    with pytest.raises(ValueError):
        audio.decode(bad)

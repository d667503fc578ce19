"""Telephony audio as a media column: mu-law and A-law by lookup tables, IMA ADPCM in blocks, resampled PCM.

Stored form: a WAV of 8-bit samples (format 6, A-law, or 7, mu-law; 8000 a second, one channel), header and payload
in one binary value; or of ADPCM blocks (format 17). Codes are stored as they are, so the payload is read back byte for
byte. Decoding: a table of 256 values for A-law and mu-law; for ADPCM a loop over the places of a block, each step for
all blocks of a batch at once. PCM is resampled, by linear interpolation upwards and by means downwards, and stored
as a WAV of 16-bit samples beside the coded one. The query deals the three codings out by a checksum of the payload and
stores PCM at half the rate, as its disk is bounded; both are parameters.

Defined results: null and empty texts are a payload of 64 zero bytes; a text of any length is one value, as long as that
and its PCM fit in a row (2 GB); damaged or foreign media raise ValueError; equal ids and repeated rows each keep a row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import released, slices, small_batches, stored, utf8

UNIT, RATE = 64, 8000
PCM, ALAW, ULAW, ADPCM = 1, 6, 7, 17


def _ulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int64) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int64) ^ 0x55
    exponent, low = (code >> 4) & 7, ((code & 0x0F) << 4) + 8
    size = np.where(exponent == 0, low, low + 0x100 << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


ULAW_PCM, ALAW_PCM = _ulaw_table(), _alaw_table()
# The step sizes of IMA ADPCM and the changes of the step's index.
STEPS = np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
_NIBBLE = np.arange(8)
#: by index and the three low bits of a code: the change of the sample, and the next index
CHANGE = (STEPS[:, None] >> 3) + np.where(_NIBBLE & 4, STEPS[:, None], 0) + np.where(_NIBBLE & 2, STEPS[:, None] >> 1, 0) + np.where(_NIBBLE & 1, STEPS[:, None] >> 2, 0)
SIGNED = np.concatenate([CHANGE, -CHANGE], axis=1).astype(np.int32)
NEXT = np.clip(np.arange(len(STEPS))[:, None] + np.concatenate([MOVES, MOVES]), 0, len(STEPS) - 1).astype(np.int32)


def wav(payload: bytes, kind: int, *, rate: int = RATE, block: int = 1) -> bytes:
    bits = {PCM: 16, ALAW: 8, ULAW: 8, ADPCM: 4}[kind]
    block = {PCM: 2, ADPCM: block}.get(kind, 1)
    per_second = rate * block // ((block - 4) * 2 + 1) if kind == ADPCM else rate * block
    extra = struct.pack("<HH", 2, (block - 4) * 2 + 1) if kind == ADPCM else b"" if kind == PCM else struct.pack("<H", 0)
    fmt = struct.pack("<HHIIHH", kind, 1, rate, per_second, block, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(payload) & 0xFFFFFFFF) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", len(body) & 0xFFFFFFFF) + body


def read_wav(media: bytes) -> tuple[int, int, int, bytes]:
    """(kind, rate, block, payload)."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV")
    at, kind = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, block, _ = struct.unpack_from("<HHIIHH", media, at + 8)
            if channels != 1:
                raise ValueError("one channel is expected")
        elif name == b"data":
            if kind is None or at + 8 + size > len(media):
                raise ValueError("the WAV is cut off")
            return kind, rate, block, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("the WAV has no data")


def adpcm_decode(payload: bytes, block: int = UNIT) -> np.ndarray:
    """(blocks, samples) of whole IMA blocks: a sample and an index each, then two codes a byte, the low one first."""
    raw = np.frombuffer(payload, np.uint8).reshape(-1, block)
    sample = (raw[:, 0].astype(np.int32) | raw[:, 1].astype(np.int32) << 8).astype(np.int16).astype(np.int32)
    index = np.minimum(raw[:, 2], len(STEPS) - 1).astype(np.int32)
    codes = np.ascontiguousarray(raw[:, 4:].T)
    out = np.empty(((block - 4) * 2 + 1, len(raw)), np.int16)
    out[0] = sample
    signed, following = SIGNED.ravel(), NEXT.ravel()
    for i, byte in enumerate(codes):
        for half, code in enumerate((byte & 15, byte >> 4)):
            at = (index << 4) + code
            sample = np.clip(sample + signed[at], -32768, 32767)
            index = following[at]
            out[1 + 2 * i + half] = sample
    return out.T


def decode_all(media: list[bytes]) -> list[tuple[int, bytes, np.ndarray]]:
    """(rate, payload, 16-bit samples) of WAVs of any of the four kinds; ADPCM blocks of one size are decoded together."""
    read = [read_wav(m) for m in media]
    out: list = [None] * len(read)
    blocks: dict[int, list[int]] = {}
    for i, (kind, rate, block, payload) in enumerate(read):
        if kind == PCM:
            out[i] = rate, payload, np.frombuffer(payload, "<i2")
        elif kind in (ALAW, ULAW):
            out[i] = rate, payload, (ALAW_PCM if kind == ALAW else ULAW_PCM)[np.frombuffer(payload, np.uint8)]
        elif kind == ADPCM and block > 4 and len(payload) % block == 0:
            blocks.setdefault(block, []).append(i)
        else:
            raise ValueError(f"format {kind} in blocks of {block}")
    for block, those in blocks.items():
        samples = adpcm_decode(b"".join(read[i][3] for i in those), block)
        cut = np.cumsum([len(read[i][3]) // block for i in those])[:-1]
        for i, own in zip(those, np.split(samples, cut), strict=True):
            out[i] = read[i][1], read[i][3], own.ravel()
    return out


def decode(media: bytes) -> tuple[int, np.ndarray]:
    """(rate, 16-bit samples) of one WAV."""
    rate, _, pcm = decode_all([media])[0]
    return rate, pcm


def resample(pcm: np.ndarray, times: int = 2) -> np.ndarray:
    """``times`` the rate, linearly between neighbours; the last sample is held. Every ``times``-th sample is the old one."""
    out = np.empty(len(pcm) * times, np.int16)
    out[::times] = pcm
    x = pcm.astype(np.int32)
    step = np.empty_like(x)
    step[:-1] = x[1:] - x[:-1]
    step[-1:] = 0
    for k in range(1, times):
        out[k::times] = x + step * k // times
    return out


def to_rate(pcm: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Samples at another rate: a multiple by interpolation, a fraction by means (the last sample fills up), any other linearly."""
    if wanted % rate == 0:
        return resample(pcm, wanted // rate)
    if rate % wanted == 0:
        k = rate // wanted
        whole = np.concatenate([pcm, np.repeat(pcm[-1:], -len(pcm) % k)]).astype(np.int32).reshape(-1, k)
        return (whole.sum(axis=1) // k).astype(np.int16)
    at = np.arange(max(1, len(pcm) * wanted // rate), dtype=np.int64) * rate
    place, part = at // wanted, at % wanted
    x = pcm.astype(np.int64)
    return (x[place] + (x[np.minimum(place + 1, len(x) - 1)] - x[place]) * part // wanted).astype(np.int16)


def padded(text: bytes, unit: int = UNIT) -> bytes:
    return text + b"\0" * (max(unit, -(-len(text) // unit) * unit) - len(text))


def kind_of(payload: bytes) -> int:
    """The coding that a payload is dealt: equal payloads, equal codings."""
    return (ULAW, ALAW, ADPCM)[zlib.crc32(payload) % 3]


def media_column(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", kind: int | None = ULAW, pcm: int = 0, rate: int = 0) -> DataFrame:
    """doc_id, n_bytes, media: the text's bytes as samples, or blocks, in a WAV of that kind (None: dealt by the payload); with
    ``pcm`` also the samples at that multiple of the rate, with ``rate`` at that rate."""
    wanted = rate or RATE * pcm
    names = ["doc_id", "n_bytes", "media", *["pcm"] * bool(wanted)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            for a, b in slices(texts, 2 << 20):
                payloads = [padded(t) for t in texts[a:b]]
                media = [wav(p, kind_of(p) if kind is None else kind, block=UNIT) for p in payloads]
                columns = [ids.slice(a, b - a), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(media, pa.binary())]
                if wanted:
                    columns.append(pa.array([wav(to_rate(x, r, wanted).astype("<i2").tobytes(), PCM, rate=wanted) for r, _, x in decode_all(media)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(released(run), "doc_id long, n_bytes long, media binary" + ", pcm binary" * bool(wanted))


def features(pcm: np.ndarray, stored_pcm: np.ndarray, rate: int) -> str:
    """Level, crossings and digests of the decoded samples and of the resampled ones as they were stored."""
    x = pcm.astype(np.int64)
    crossings = int(((pcm[1:] < 0) != (pcm[:-1] < 0)).sum())
    crc = lambda y: zlib.crc32(np.ascontiguousarray(y, "<i2").tobytes())
    return f"n={len(pcm)};peak={int(np.abs(x).max())};energy={int(x @ x)};crossings={crossings};pcm_crc32={crc(pcm)};rate={rate};n_resampled={len(stored_pcm)};resampled_crc32={crc(stored_pcm)}"


def described(media: DataFrame) -> DataFrame:
    """What is read back from stored media with PCM beside them: payload, digests and features."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(2).to_pylist()
            for a, b in slices(held, 2 << 20):
                out = []
                resampled = decode_all(batch.column(3).slice(a, b - a).to_pylist())
                own = zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), held[a:b], decode_all(held[a:b]), resampled, strict=True)
                for doc_id, n, m, (_, payload, pcm), (rate, _, again) in own:
                    out.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(), features(pcm, again, rate)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.select("doc_id", "n_bytes", "media", "pcm").mapInArrow(released(run), schema)


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns; all three codings, and PCM at half the rate, are stored and read back."""
    return described(stored(media_column(docs, kind=None, rate=RATE // 2), "telephony", level=12))

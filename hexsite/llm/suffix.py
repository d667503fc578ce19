"""Suffix-array deduplication: bytes covered by a LENGTH-byte string that also starts in a document with a smaller id.

Suffix arrays by two-stage sorting: only suffixes smaller than their successors are sorted directly (by their first
LENGTH bytes, in words of eight); all others follow by one scan over the buckets of first bytes, each bucket giving its
predecessors, in order, to larger buckets. Then the common prefixes of neighbours are computed, neighbours that share
LENGTH bytes are one group, and a window is a repeat if its group has a smaller doc_id.

One array over all documents can't be held anywhere, so windows are dealt out by content. The key of a window is the
least hash of its GRAM-byte strings: equal windows have equal keys. Neighbouring windows with one key make a segment,
about one for 18 bytes of text. Steps, each over parts of bounded size:

1. Each task writes its documents in chunks to the shared folder, and sends the key, a digest and the least doc_id of
   each distinct segment to the key's bucket. Copies inside a chunk are told by comparing their bytes.
2. A bucket asks for the segments of each key that several documents have. Digests decide nothing; they only spare the
   chunk from sending a segment twice.
3. Chunks send the bytes of those segments.
4. A bucket puts equal segments together, by comparing their bytes, and builds the suffix array over all that differ
   under one key. It answers with ranges of windows.
5. Chunks mark what was answered, cut it out and give the digests.

A key that many documents share is one entry for each chunk at most; suffix arrays are built over a few MB of whole keys
at a time, and a key that is larger has its windows dealt out once more, by their content. Chunks are named by the attempt
that wrote them, and what the first step sends is stored before it is used, so only chunks of attempts that came to their end are
ever named in it. A chunk sends a message for each bucket that it has segments for: there are as many buckets as chunks,
so messages grow faster than the input until each segment is one; they are small beside the segments up to some TB.

Defined results: null and empty texts have 0 bytes; shorter texts than LENGTH keep all; equal doc_ids aren't smaller
than one another, so repeated rows remove nothing from each other; a null doc_id counts as smaller than all others; a
text of any length is one document of one chunk, however large; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import mix, open_fs, partitions, released, shared_dir, small_batches, stored, utf8

LENGTH, GRAM = 50, 16
WINDOW = LENGTH - GRAM + 1
CHUNK, BUCKET = 12 << 20, 8 << 20
NONE = np.iinfo(np.int64).min
_RANDOM = np.random.default_rng(50)
BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = (_RANDOM.integers(1, 1 << 62, 8) * 2 + 1).astype(np.uint64)


# --- suffix arrays ----------------------------------------------------------------------------------------


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a big-endian number; zeros follow the end."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(LENGTH + 30, np.uint8)])
    out = np.empty(n + LENGTH + 14, np.uint64)
    for o in range(8):
        part = out[o::8]
        part[:] = np.frombuffer(padded[o : o + 8 * len(part)].tobytes(), ">u8")
    return out


def _direct(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places in the order of the LENGTH bytes that begin there."""
    order = places[np.argsort(words[places])]
    first = words[order]
    new = np.concatenate([[True], first[1:] != first[:-1]])
    for depth in range(8, LENGTH, 8):
        alone = new & np.concatenate([new[1:], [True]])
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        part = words[order[tied] + depth]
        if depth + 8 > LENGTH:
            part = part >> np.uint64(8 * (depth + 8 - LENGTH))
        by = np.lexsort((part, group))
        order[tied] = order[tied][by]
        part = part[by]
        new[tied] |= np.concatenate([[True], part[1:] != part[:-1]])
    return order


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """All suffixes in the order of their first LENGTH bytes at least, by two-stage sorting."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    differs = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    if len(differs):
        ahead = np.searchsorted(differs, np.arange(n - 1))
        there = np.flatnonzero(ahead < len(differs))
        turn = differs[ahead[there]]
        smaller[there] = text[turn] < text[turn + 1]
    direct = _direct(words, np.flatnonzero(smaller)) if smaller.any() else np.zeros(0, np.int64)
    cut = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))  # the last suffix follows from the empty one
    out = []
    for c in range(256):
        part = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        bucket = []
        while len(part):
            bucket.append(part)
            part = part[part > 0] - 1
            part = part[text[part] == c]  # runs of one byte induce within their own bucket
        bucket.append(direct[cut[c] : cut[c + 1]])
        bucket = np.concatenate(bucket)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        if len(before):
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            edge = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1], [True]]))
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                waiting[byte[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes, up to LENGTH, that each place of the order shares with the one before; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for depth in range(0, LENGTH, 8):
        x = words[order[open_] + depth] ^ words[order[open_ - 1] + depth]
        top = np.zeros(len(x), np.int64)
        for k in range(1, 9):
            top += x < np.uint64(1 << (64 - 8 * k)) if k < 8 else x == 0
        shared[open_] += top
        open_ = open_[top == 8]
    return np.minimum(shared, LENGTH)


# --- segments ---------------------------------------------------------------------------------------------


class Segments:
    """Segments of some documents: place of the first window, number of windows, key, digest, document."""

    def __init__(self, texts: list[bytes], ids: np.ndarray):
        parts, base = [], 0
        held, first = [], 0
        size = 0
        for i, t in enumerate([*texts, None]):
            if t is not None:
                held.append(t)
                size += len(t)
            if held and (t is None or size >= 1 << 20):
                parts.append((*self._of(held, base), first))
                base += size
                first, held, size = i + 1, [], 0
        cat = lambda k, kind: np.concatenate([p[k] for p in parts] or [np.zeros(0, kind)])
        self.raw = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
        self.start, self.windows, self.key, self.digest = cat(0, np.int64), cat(1, np.int64), cat(2, np.uint64), cat(3, np.uint64)
        self.doc = np.concatenate([p[4] + p[5] for p in parts] or [np.zeros(0, np.int64)])
        self.id = ids[self.doc] if len(self.doc) else np.zeros(0, np.int64)

    @staticmethod
    def _of(texts: list[bytes], base: int) -> tuple:
        lengths = np.array([len(t) for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        n = len(raw)
        if n < LENGTH:
            z = np.zeros(0, np.int64)
            return z, z, z.astype(np.uint64), z.astype(np.uint64), z
        h = BYTE[raw]
        for k in range(4):
            h = h[: -(1 << k)] * STEP[k] + h[1 << k :]
        h = mix(h)
        least = h
        for k in range(5):
            least = np.minimum(least[: -(1 << k)], least[1 << k :])
        least = np.minimum(least[: -(WINDOW - 32)], least[WINDOW - 32 :])
        begin = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.zeros(len(least) + 1, bool)
        for d in np.flatnonzero(lengths >= LENGTH):
            inside[begin[d] : begin[d + 1] - LENGTH + 1] = True
        inside = inside[:-1]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(least))
        ok = inside[starts]
        starts, ends = starts[ok], ends[ok]
        many = -(-(ends - starts) // WINDOW)  # runs of a repeated string are cut
        if (many > 1).any():
            k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            starts, ends = np.repeat(starts, many) + k * WINDOW, np.repeat(ends, many)
            ends = np.minimum(ends, starts + WINDOW)
        windows = ends - starts
        last = starts + windows - 1 + LENGTH - GRAM
        total = windows.astype(np.uint64)
        for k in range(-(-(LENGTH + WINDOW) // GRAM)):
            total += h[np.minimum(starts + GRAM * k, last)] * STEP[k]
        doc = np.searchsorted(begin, starts, side="right") - 1
        return starts + base, windows, mix(least[starts]), mix(total) >> np.uint64(16), doc

    def distinct(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(order, first, bucket, cut): segments by bucket, key, digest and id; where each distinct one begins; buckets' bounds.

        A segment counts as another's copy only if the bytes of both are the same."""
        bucket = ((self.key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((self.id, self.digest, self.key, bucket))
        key, digest = self.key[order], self.digest[order]
        new = np.ones(len(order), bool)
        alike = np.flatnonzero((key[1:] == key[:-1]) & (digest[1:] == digest[:-1]) & (self.windows[order[1:]] == self.windows[order[:-1]])) + 1
        a, b = order[alike], order[alike - 1]
        new[alike] = ~same_bytes(self.raw, self.start[a], self.start[b], self.windows[a] + LENGTH - 1)
        first = np.flatnonzero(new)
        owner = bucket[order][first]
        return order, first, owner, np.searchsorted(owner, np.arange(buckets + 1))


def same_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes, eight at least, from each place of ``a`` are those from ``b``."""
    if not len(a):
        return np.zeros(0, bool)
    word = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    out = np.ones(len(a), bool)
    for o in range(0, int(length.max()) - 7, 8):
        here = np.minimum(o, length - 8)  # a last word that overlaps the one before
        out &= word[a + here] == word[b + here]
    here = length - 8
    return out & (word[a + here] == word[b + here])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: of each, all first bytes, then all second ones, as ids have equal high bytes."""
    import zstandard

    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unpack(raw: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, n in json.loads(raw[4:at]):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


# --- steps ------------------------------------------------------------------------------------------------

MESSAGE = "bucket int, chunk string, kind string, body binary"


def _message(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.string(), pa.binary()), strict=True)], names=["bucket", "chunk", "kind", "body"])


def _load(folder: str, chunk: str) -> tuple[list[bytes], np.ndarray, list]:
    import pyarrow.parquet as pq

    fs, at = open_fs(folder)
    got = pq.read_table(f"{at}/{chunk}", filesystem=fs)
    ids = got.column("doc_id").to_pylist()
    return got.column("text").to_pylist(), np.array([NONE if i is None else i for i in ids], np.int64), ids


def _first_step(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import pyarrow.parquet as pq

        fs, at = open_fs(folder)
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, texts, size
            name = f"chunk-{uuid.uuid4().hex}.parquet"  # of this attempt alone
            pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())}), f"{at}/{name}", filesystem=fs, compression="zstd", compression_level=3, use_dictionary=False, write_statistics=False)
            s = Segments(texts, np.array([NONE if i is None else i for i in ids], np.int64))
            ids, texts, size = [], [], 0
            order, first, _, cut = s.distinct(buckets)
            lead = order[first]
            key, doc = s.key[lead], s.id[lead]
            yield _message([(-1, name, "chunk", None)])
            for b in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                x = slice(cut[b], cut[b + 1])
                k = key[x]
                yield _message([(b, name, "keys", pack((k >> np.uint64(32)).astype(np.uint32), (k >> np.uint64(24)).astype(np.uint8), doc[x]))])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= CHUNK:
                    yield from flush()
        if ids:
            yield from flush()

    return run


def _second_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket asks the chunks for the segments of each key that several documents have."""
    for (bucket,), got in _by_bucket(batches):
        parts = [unpack(b) for b in got["body"]]
        sizes = [len(p[0]) for p in parts]
        key = np.concatenate([p[0].astype(np.uint64) << np.uint64(8) | p[1] for p in parts])
        doc = np.concatenate([p[2] for p in parts])
        del parts
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        least, most = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
        several = np.zeros(len(key), bool)
        several[order] = np.repeat(least < most, np.diff(np.append(starts, len(key))))
        at = 0
        for chunk, n in zip(got["chunk"], sizes, strict=True):
            asked = np.flatnonzero(several[at : at + n])
            at += n
            if len(asked):
                yield _message([(bucket, chunk, "asked", pack(asked.astype(np.uint32)))])


def _by_bucket(batches: Iterator[pa.RecordBatch], column: str = "bucket"):
    from hexsite.llm.jaccard import _groups

    rest = [c for c in ("bucket", "chunk", "kind", "body") if c != column]
    return _groups((b.select([column, *rest]) for b in batches), 1)


def _third_step(folder: str, buckets: int):
    """Bytes of the segments that were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), got in _by_bucket(batches, "chunk"):
            asked = [(b, unpack(x)[0]) for b, x in zip(got["bucket"], got["body"], strict=True)]
            texts, ids, _ = _load(folder, chunk)
            s = Segments(texts, ids)
            order, first, _, cut = s.distinct(buckets)
            for b, places in asked:
                lead = order[first[cut[b] + places.astype(np.int64)]]
                length = s.windows[lead] + LENGTH - 1
                at = np.arange(length.sum()) + np.repeat(s.start[lead] - (np.cumsum(length) - length), length)
                yield _message([(b, chunk, "bytes", pack(places, s.id[lead], length.astype(np.uint8), s.raw[at], (s.key[lead] >> np.uint64(24)).astype(np.uint32)))])

    return run


def _repeats(text: np.ndarray, begin: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of ``text`` whose window starts, in the segments' order, in a segment of a smaller document too.

    One suffix array over the segments, one after the other.
    """
    own = np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)
    part = text[own]
    at = np.cumsum(length) - length
    words = words_at(part)
    order = suffix_array(part, words)
    owner = np.repeat(np.arange(len(length), dtype=np.int32), length)
    order = order[order - at[owner[order]] <= length[owner[order]] - LENGTH]
    group = np.flatnonzero(common_prefixes(words, order) < LENGTH)
    of = doc[owner[order]]
    least = np.repeat(np.minimum.reduceat(of, group), np.diff(np.append(group, len(order))))
    return own[order[of > least]]


def _batches(size: np.ndarray, key: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Segments, whole keys together, of about ``most`` bytes; and whether it is one key that alone is larger."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
    total = np.concatenate([[0], np.cumsum(size[order])])
    a = 0
    while a < len(edge) - 1:
        b = max(a + 1, int(np.searchsorted(total[edge], total[edge[a]] + most, side="right")) - 1)
        yield order[edge[a] : edge[b]], bool(total[edge[b]] - total[edge[a]] > most)
        a = b


ARRAY = 3 << 20


def _marks(text: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A number for the ``length`` bytes, eight at least, from each place."""
    word = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    mark = length.astype(np.uint64)
    for o in range(0, int(length.max(initial=0)), 8):
        left = np.flatnonzero(length > o)
        mark[left] = mix(mark[left] ^ word[first[left] + np.minimum(o, length[left] - 8)])
    return mark


def _ranges(text: np.ndarray, length: np.ndarray, doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, window after the last) of windows that are repeats, of segments that stand one after the other
    in ``text`` (and eight bytes more): all of a segment whose bytes a smaller document has, and of the others what a suffix
    array over the differing segments of a key shows."""
    begin = np.cumsum(length) - length
    # equal segments stand together, the least document first; each is compared with the one before
    mark = _marks(text, begin, length)
    order = np.lexsort((doc, mark, length, key))
    alike = np.flatnonzero((mark[order[1:]] == mark[order[:-1]]) & (length[order[1:]] == length[order[:-1]]) & (key[order[1:]] == key[order[:-1]])) + 1
    new = np.ones(len(order), bool)
    new[alike] = ~same_bytes(text, begin[order[alike]], begin[order[alike - 1]], length[order[alike]])
    lead = np.empty(len(order), np.int64)  # of each segment, the one it equals
    lead[order] = np.repeat(order[new], np.diff(np.append(np.flatnonzero(new), len(order))))
    whole = doc > doc[lead]
    first = order[new]

    # of the others, those whose key has several
    edge = np.flatnonzero(np.concatenate([[True], key[first][1:] != key[first][:-1], [True]]))  # in the order of keys
    differ = np.sort(first[np.repeat(np.diff(edge) > 1, np.diff(edge))])
    del mark, order, alike, new, first
    repeat = np.zeros(len(text) + 1, bool)
    for some, large in _batches(length[differ], key[differ], ARRAY):
        some = differ[some]
        if not large:
            repeat[_repeats(text, begin[some], length[some], doc[some])] = True
            continue
        # one key in very many segments: each window by itself, dealt into batches by its content
        many = length[some] - LENGTH + 1
        start = np.arange(many.sum()) + np.repeat(begin[some] - (np.cumsum(many) - many), many)
        own = np.repeat(doc[some], many)
        for again, _ in _batches(np.full(len(start), LENGTH), _marks(text, start, np.full(len(start), LENGTH)), ARRAY):
            repeat[_repeats(text, start[again], np.full(len(again), LENGTH), own[again])] = True
    edge = np.diff(np.concatenate([[0], repeat.astype(np.int8)]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # never across segments: each ends in places that are no window
    seg = np.searchsorted(begin, a, side="right") - 1
    a, b = a - begin[seg], b - begin[seg]
    # what holds for a segment holds for its equals in the same document
    equal = np.flatnonzero(~whole & (lead != np.arange(len(lead))))
    low, high = np.searchsorted(seg, lead[equal]), np.searchsorted(seg, lead[equal], side="right")
    n = high - low
    more = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
    all_ = np.flatnonzero(whole)
    return np.concatenate([seg, np.repeat(equal, n), all_]), np.concatenate([a, a[more], np.zeros(len(all_), np.int64)]), np.concatenate([b, b[more], length[all_] - LENGTH + 1])


def _fourth_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of windows that are repeats, for a bucket's segments, a few MB of whole keys at a time."""
    for (bucket,), got in _by_bucket(batches):
        parts = [unpack(b) for b in got.pop("body")]
        text = np.concatenate([p[3] for p in parts])
        length = np.concatenate([p[2] for p in parts])
        doc = np.concatenate([p[1] for p in parts])
        key = np.concatenate([p[4] for p in parts])
        bound = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
        places = [p[0] for p in parts]
        del parts
        begin = np.cumsum(length, dtype=np.int64) - length
        found = []
        for some, _ in _batches(length.astype(np.int64), key, ARRAY):
            n = length[some].astype(np.int64)
            own = np.arange(n.sum()) + np.repeat(begin[some] - (np.cumsum(n) - n), n)
            seg, a, b = _ranges(np.concatenate([text[own], np.zeros(8, np.uint8)]), n, doc[some], key[some])
            del own
            found.append((some[seg].astype(np.int32), a.astype(np.uint8), b.astype(np.uint8)))
        seg, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(seg, kind="stable")
        seg, a, b = seg[by], a[by], b[by]
        cut = np.searchsorted(seg, bound)
        for m, chunk in enumerate(got["chunk"]):
            x = slice(cut[m], cut[m + 1])
            if cut[m] < cut[m + 1]:
                yield _message([(bucket, chunk, "ranges", pack(places[m][seg[x] - bound[m]], a[x], b[x]))])


def _last_step(folder: str, buckets: int, text_out: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), got in _by_bucket(batches, "chunk"):
            texts, ids, own = _load(folder, chunk)
            s = Segments(texts, ids)
            order, first, _, cut = s.distinct(buckets)
            spots, lows, highs = [], [], []
            for b, kind, body in zip(got["bucket"], got["kind"], got["body"], strict=True):
                if kind == "ranges":
                    places, x, y = unpack(body)
                    spots.append(cut[b] + places.astype(np.int64))
                    lows.append(x.astype(np.int64))
                    highs.append(y.astype(np.int64))
            size = sum(map(len, texts))
            mark = np.zeros(size + 1, np.int32)
            of = np.zeros(len(order), np.int64)
            of[first] = 1
            of = np.cumsum(of) - 1
            later = s.id[order] > s.id[order[first]][of] if len(order) else np.zeros(0, bool)
            full = order[later]
            np.add.at(mark, s.start[full], 1)
            np.add.at(mark, s.start[full] + s.windows[full] - 1 + LENGTH, -1)
            if spots:
                spot, low, high = np.concatenate(spots), np.concatenate(lows), np.concatenate(highs)
                count = np.diff(np.append(first, len(order)))[spot]
                at = np.arange(count.sum()) + np.repeat(first[spot] - (np.cumsum(count) - count), count)
                low, high = np.repeat(low, count), np.repeat(high, count)
                keep = ~later[at]
                where = s.start[order[at[keep]]]
                np.add.at(mark, where + low[keep], 1)
                np.add.at(mark, where + high[keep] - 1 + LENGTH, -1)
            removed = np.cumsum(mark[:-1]) > 0
            out, base = [], 0
            for doc_id, t in zip(own, texts, strict=True):
                gone = removed[base : base + len(t)]
                base += len(t)
                n = int(gone.sum())
                rest = np.frombuffer(t, np.uint8)[~gone].tobytes() if n else t
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if n else 0
                out.append((doc_id, len(t), n, spans, rest if text_out else hashlib.sha256(rest).hexdigest()))
            for a in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[a : a + 2000], strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary() if text_out else pa.string()), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: the bytes that remain, or with ``digests`` their SHA-256 in hex."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "suffix-chunks")
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = int(source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"])
    buckets = max(1, -(-total // min(BUCKET, CHUNK)))
    fs, at = open_fs(folder)
    fs.create_dir(at, recursive=True)

    small_batches(spark)
    sent = stored(source.mapInArrow(released(_first_step(folder, buckets)), MESSAGE), "suffix-keys")  # names only chunks of attempts that ended
    chunks = sent.filter("kind = 'chunk'")
    n = partitions(chunks.count())
    answers = sent.filter("kind = 'keys'").repartition(partitions(buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(released(_second_step), MESSAGE)
    asked = answers.repartition(n, "chunk").sortWithinPartitions("chunk").mapInArrow(released(_third_step(folder, buckets)), MESSAGE)
    ranges = asked.repartition(partitions(buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(released(_fourth_step), MESSAGE)
    heard = chunks.unionByName(ranges).repartition(n, "chunk").sortWithinPartitions("chunk")
    return heard.mapInArrow(released(_last_step(folder, buckets, not digests)), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if digests else 'binary'}")


def op9(docs: DataFrame) -> DataFrame:
    return without_repeats(docs, digests=True).withColumnRenamed("kept", "kept_sha256")


def brute_force(rows: list[tuple[int | None, str | None]], length: int = LENGTH) -> dict:
    """The contract by a table of all windows; for tests."""
    least: dict[bytes, int] = {}
    texts = [(NONE if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            least[w] = min(least.get(w, i), i)
    out = {}
    for n, (i, t) in enumerate(texts):
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if least[t[s : s + length]] < i:
                gone[s : s + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[n] = (rows[n][0], len(t), sum(gone), sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out

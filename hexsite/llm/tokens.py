"""Token ids in a binary format: static range asymmetric numeral system (rANS) over shared frequency tables.

Files of one folder share ``table.rans``: the ids that occur in the whole corpus and their frequencies, which sum to
2**SCALE. A shard holds the ids of a range of doc_id in ascending order. Its ids are cut into blocks of LANES x STEPS;
a block is coded by LANES interleaved states that share one stream of 32-bit words, and needs no other block. The
footer is a list of checkpoints (byte offset, first id, count, CRC-32 of each block) and of documents (doc_id, start,
count), so blocks can be decoded in parallel and any document can be read alone. numpy runs the states of many blocks
at once.

Steps: tokenize once and store the ids (with each task's histogram); add up the histograms (at most one row for each
id of the vocabulary reaches the driver); range-partition by doc_id, sort, encode and write one shard a task, under a
name of the attempt's own, so that the stored manifest names shards of attempts that ended only; add up the shards' counts for global starts; read the shards back.

Tokenizing looks words up: a text is cut before each single space, where this pre-tokenizer always cuts too, and
the library encodes each distinct piece once. A piece is looked up by a hash of 64 bits and then compared, all bytes of
it. Texts in which white space follows a space, or that end with one, or with a piece whose hash is another's, are encoded whole.

Defined results: null and empty texts have the end id only; texts of any length are encoded whole and are in one shard;
equal doc_ids are ordered by their ids and each keeps its row; null doc_ids come first; an empty table gives no shard and no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexsite.llm._shared import mix, open_fs, partitions, released, shared_dir, small_batches, utf8, write_atomically

END, SCALE, LANES, STEPS, SLAB = 2, 20, 64, 512, 48
LOW = np.uint64(1 << 31)
MAGIC = b"RANSIDS1"


# --- the coder --------------------------------------------------------------------------------------------


class Table:
    """Frequencies of the ids that occur, scaled to sum to 2**SCALE."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.common = int(self.ids[int(self.freq.argmax())]) if len(ids) else 0
        place = np.zeros(int(self.ids.max()) + 1 if len(ids) else 1, np.int64)
        place[self.ids] = np.arange(len(ids))
        self.place = place
        self.slot = np.repeat(np.arange(len(ids), dtype=np.uint32), self.freq.astype(np.int64))

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(np.float64)
        if len(ids) > 1 << (SCALE - 1):
            raise ValueError("the vocabulary is too large for this scale")
        freq = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (1 << SCALE))).astype(np.int64)
        left = (1 << SCALE) - int(freq.sum())
        for i in np.argsort(-freq, kind="stable"):
            give = left if left > 0 else -min(-left, int(freq[i]) - 1)
            freq[i] += give
            left -= give
            if not left:
                break
        return cls(ids, freq)

    def to_bytes(self) -> bytes:
        body = struct.pack("<II", SCALE, len(self.ids)) + self.ids.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()
        return MAGIC + body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        body = raw[len(MAGIC) : -4]
        if raw[: len(MAGIC)] != MAGIC or zlib.crc32(body) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("the frequency table is damaged")
        scale, n = struct.unpack_from("<II", body)
        if scale != SCALE:
            raise ValueError(f"scale {scale}")
        return cls(np.frombuffer(body, "<u4", n, 8), np.frombuffer(body, "<u4", n, 8 + 4 * n))


def encode_blocks(ids: np.ndarray, steps: int, table: Table) -> list[bytes]:
    """Blocks of LANES x steps ids (the last is filled up): states, then the words in the order of decoding."""
    n = -(-len(ids) // (LANES * steps))
    full = np.full(n * LANES * steps, table.common, np.uint32)
    full[: len(ids)] = ids
    where = table.place[full].reshape(n, steps, LANES)
    x = np.full((n, LANES), LOW, np.uint64)
    out, words = np.zeros((steps, n, LANES), bool), np.zeros((steps, n, LANES), np.uint32)
    scale, shift, half = np.uint64(SCALE), np.uint64(63 - SCALE), np.uint64(32)
    for s in range(steps - 1, -1, -1):
        f, c = table.freq[where[:, s]], table.start[where[:, s]]
        over = x >= f << shift
        out[s], words[s] = over, x.astype(np.uint32)
        x = np.where(over, x >> half, x)
        q = x // f
        x = (q << scale) + (x - q * f) + c
    out, words = out.transpose(1, 0, 2), words.transpose(1, 0, 2)
    return [x[b].astype("<u8").tobytes() + words[b][out[b]].astype("<u4").tobytes() for b in range(n)]


def decode_blocks(blocks: list[bytes], steps: int, table: Table) -> np.ndarray:
    """Ids of equally long blocks, (blocks, LANES x steps); the states must end where encoding began."""
    n = len(blocks)
    x = np.stack([np.frombuffer(b, "<u8", LANES) for b in blocks]).astype(np.uint64)
    words = np.concatenate([*[np.frombuffer(b, "<u4", -1, 8 * LANES) for b in blocks], np.zeros(1, "<u4")]).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum([(len(b) - 8 * LANES) // 4 for b in blocks])])[:-1]
    out = np.empty((n, steps, LANES), np.uint32)
    scale, mask, half = np.uint64(SCALE), np.uint64((1 << SCALE) - 1), np.uint64(32)
    for s in range(steps):
        slot = x & mask
        k = table.slot[slot.astype(np.int64)]
        out[:, s] = table.ids[k]
        x = table.freq[k] * (x >> scale) + slot - table.start[k]
        under = x < LOW
        rank = np.cumsum(under, axis=1)
        word = words[np.minimum(at[:, None] + rank - 1, len(words) - 1) * under]
        x = np.where(under, (x << half) | word, x)
        at = at + rank[:, -1]
    if not (x == LOW).all():
        raise ValueError("a block is damaged")
    return out.reshape(n, -1)


class ShardWriter:
    """Appends ids of documents in order; full slabs of blocks are coded and written as they fill."""

    def __init__(self, out, table: Table):
        self.out, self.table, self.held, self.n_held = out, table, [], 0
        self.blocks, self.docs, self.n_ids, self.offset = [], [], 0, 0
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.offset += len(raw)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= SLAB * LANES * STEPS:
            self._code(False)

    def _code(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        size = LANES * STEPS
        whole = len(ids) // size * size
        for a in range(0, whole, SLAB * size):
            self._write(ids[a : min(a + SLAB * size, whole)], STEPS)
        rest = ids[whole:]
        if last and len(rest):
            self._write(rest, -(-len(rest) // LANES))
            rest = rest[:0]
        self.held, self.n_held = [rest], len(rest)

    def _write(self, ids: np.ndarray, steps: int) -> None:
        size = LANES * steps
        for i, raw in enumerate(encode_blocks(ids, steps, self.table)):
            own = ids[i * size : (i + 1) * size]
            first = self.blocks[-1][2] + self.blocks[-1][3] if self.blocks else 0
            self.blocks.append((self.offset, len(raw), first, len(own), steps, zlib.crc32(own.astype("<u4").tobytes())))
            self._put(raw)

    def close(self) -> None:
        self._code(True)
        foot = json.dumps({"blocks": self.blocks, "docs": self.docs, "n_ids": self.n_ids}).encode()
        foot = zlib.compress(foot, 1)
        self._put(foot + struct.pack("<II", len(foot), zlib.crc32(foot)) + MAGIC)


def shard_footer(raw: bytes) -> dict:
    tail = len(MAGIC)
    size, crc = struct.unpack("<II", raw[-tail - 8 : -tail])
    foot = raw[-tail - 8 - size : -tail - 8]
    if raw[-tail:] != MAGIC or zlib.crc32(foot) != crc:
        raise ValueError("the shard's footer is damaged")
    return json.loads(zlib.decompress(foot))


def shard_ids(raw: bytes, foot: dict, table: Table) -> np.ndarray:
    """All ids of a shard, block by block, each held against its checksum."""
    parts = []
    for steps, own in itertools.groupby(foot["blocks"], key=lambda b: b[4]):
        own = list(own)
        for a in range(0, len(own), SLAB):
            some = own[a : a + SLAB]
            for b, ids in zip(some, decode_blocks([raw[o : o + n] for o, n, *_ in some], steps, table), strict=True):
                ids = ids[: b[3]]
                if zlib.crc32(ids.astype("<u4").tobytes()) != b[5]:
                    raise ValueError("a block's checksum differs")
                parts.append(ids)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# --- tokenizing -------------------------------------------------------------------------------------------


class Pieces:
    """Packed ids of texts, by a table of the pieces between spaces that were met before.

    The table is numpy arrays: sorted 64-bit hashes of pieces, and where their ids stand in a pool. A slab of texts is
    cut at its spaces, all pieces are hashed at once, and ids are gathered from the pool; only pieces that are new go to
    the library, many as one line, cut again by the tokens' byte lengths. A table of ``most`` pieces is begun anew.
    """

    def __init__(self, path: str, most: int = 1_600_000):
        import os

        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and each thread would hold memory of its own
        self.library = Tokenizer.from_file(path)
        step = self.library.pre_tokenizer
        self.by_piece = self.library.normalizer is None and isinstance(step, pre_tokenizers.ByteLevel) and step.use_regex and not step.add_prefix_space
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([END], self.kind).tobytes()
        vocabulary = self.library.get_vocab()
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.length[i] = len(token)  # a character of this vocabulary is a byte of text
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0
        self.words, self.word_at, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for a in range(0, len(texts), 64):  # the library's own results are large
            out += [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast(texts[a : a + 64], add_special_tokens=False)]
        return out

    @staticmethod
    def _hash(raw: bytes, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """Of each piece, from its bytes eight at a time; ``raw`` has eight bytes more."""
        h = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)
        for k, left, word in Pieces._eights(raw, start, size):
            h[left] = mix((h[left] ^ word) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(8 * k + 1))
        return h

    def _same(self, raw: bytes, start: np.ndarray, size: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether each piece is, byte by byte, the known one."""
        out = self.bytes[known] == size
        at = self.word_at[known]
        for k, left, word in self._eights(raw, start, np.where(out, size, 0)):
            out[left] &= self.words[at[left] + k] == word
        return out

    @staticmethod
    def _eights(raw: bytes, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, pieces of more than 8 k bytes, their next eight bytes as numbers); ``raw`` has eight bytes more."""
        word = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        left, done = np.flatnonzero(size > 0), 0
        while len(left):
            rest = size[left] - done
            yield done >> 3, left, word[start[left] + done] << (np.uint64(64) - np.minimum(rest, 8).astype(np.uint64) * np.uint64(8))
            done += 8
            left = left[rest > 8]

    def _learn(self, keys: np.ndarray, found: list[bytes], heads: np.ndarray) -> None:
        """Add pieces: those that begin a text are encoded as they are, others after a space."""
        ids: list[np.ndarray] = [np.zeros(0, self.kind)] * len(found)
        size = np.zeros(len(found), np.int32)
        todo = []
        for i, x in enumerate(found):
            if heads[i]:
                continue
            if not x or x.decode()[0].isspace():
                size[i] = -1  # more than one white space: its text is encoded whole
            else:
                todo.append(i)
        first = np.flatnonzero(heads).tolist()
        for i, x in zip(first, self._ids([found[i].decode() for i in first]), strict=True):
            ids[i] = x
        groups = [todo[a : a + 500] for a in range(0, len(todo), 500)]
        lines = [b" " + b" ".join([found[i] for i in g]) for g in groups]
        for group, line, got in zip(groups, lines, self._ids([x.decode() for x in lines]), strict=True):
            ends = np.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 32)[1:], len(line))
            cuts = (np.searchsorted(np.cumsum(self.length[got]), ends) + 1).tolist()
            for i, a, b in zip(group, [0, *cuts], cuts, strict=False):
                ids[i] = got[a:b]
        count = np.array([len(x) for x in ids], np.int64)
        size[size >= 0] = count[size >= 0]
        need = self.used + int(count.sum())
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(need, 2 * len(self.pool)) - self.used, self.kind)])
        self.pool[self.used : need] = np.concatenate(ids)
        at = self.used + np.cumsum(count) - count
        self.used = need
        length = np.array([len(x) for x in found], np.int64)
        many = -(-length // 8)
        word_at = len(self.words) + np.cumsum(many) - many
        words = np.zeros(int(many.sum()), np.uint64)
        for k, left, word in self._eights(b"".join(found) + b"\0" * 8, np.cumsum(length) - length, length):
            words[word_at[left] - len(self.words) + k] = word
        self.words = np.concatenate([self.words, words])
        both = [np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.size, size), (self.word_at, word_at), (self.bytes, length))]
        order = np.argsort(both[0])
        self.keys, self.at, self.size, self.word_at, self.bytes = (x[order] for x in both)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, the end id last."""
        if not self.by_piece:
            return [x.tobytes() + self.end for x in self._ids([t.decode() for t in texts])]
        raw = b" ".join(texts) + b" "
        lengths = np.array([len(t) for t in texts], np.int64)
        first = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # where each text begins
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)  # a text's last piece ends before the joining space
        start = np.concatenate([[0], ends[:-1] + 1])
        size = ends - start
        head = np.searchsorted(start, first)  # the first piece of each text
        is_head = np.zeros(len(start), bool)
        is_head[head] = True
        keys = self._hash(raw + b"\0" * 8, start, size, is_head.astype(np.uint64))
        order = np.argsort(keys)
        ordered = keys[order]
        lead = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        distinct = ordered[lead]
        if len(self.keys) > self.most:
            self._clear()
        place = np.searchsorted(self.keys, distinct)
        new = np.flatnonzero(self.keys[np.minimum(place, max(len(self.keys) - 1, 0))] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            one = order[lead[new]]
            self._learn(distinct[new], [raw[a:b] for a, b in zip(start[one].tolist(), ends[one].tolist(), strict=True)], is_head[one])
            place = np.searchsorted(self.keys, distinct)
        known = np.empty(len(keys), np.int64)
        known[order] = np.repeat(place, np.diff(np.append(lead, len(keys))))
        count = self.size[known].astype(np.int64)
        count[~self._same(raw + b"\0" * 8, start, size, known)] = -1  # another piece has this hash
        odd = np.minimum.reduceat(count, head) < 0
        count = np.maximum(count, 0)
        total = np.cumsum(count)
        flat = np.arange(total[-1]) + np.repeat(self.at[known] - (total - count), count)
        packed = self.pool[flat].tobytes()
        bounds = np.append((total - count)[head], total[-1]) * self.kind.itemsize
        out = [packed[a:b] + self.end for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._ids([texts[i].decode()])[0].tobytes() + self.end
        return out


_KNOWN: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """One cache a worker process, which later tasks find warm."""
    if path not in _KNOWN:
        _KNOWN[path] = Pieces(path)
    return _KNOWN[path]


def tokenized(docs: DataFrame, tokenizer: str, *, doc: str = "doc_id", text: str = "text", slab: int = 4 << 20) -> DataFrame:
    """doc_id and ids (packed bytes) of each document, and a row with ids null and the histogram for each task.

    ``slab``: about so many bytes of texts are encoded at once; smaller ones take less memory and more time.
    """
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(tokenizer)
        seen = np.zeros(0, np.int64)
        names = ["doc_id", "ids", "histogram"]
        for batch in batches:
            a = held = 0
            for b, n in enumerate(pc.binary_length(batch.column(1)).to_pylist(), 1):
                held += n
                if held < slab and b < batch.num_rows:
                    continue
                ids = pieces.encode(utf8(batch.column(1).slice(a, b - a)))
                got = np.bincount(np.frombuffer(b"".join(ids), pieces.kind))
                if len(got) > len(seen):
                    seen, got = got, seen
                seen[: len(got)] += got
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()), pa.nulls(b - a, pa.binary())], names=names)
                a, held = b, 0
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen.astype("<i8").tobytes()], pa.binary())], names=names)

    small_batches(docs.sparkSession)
    return source.mapInArrow(released(run), "doc_id long, ids binary, histogram binary")


def frequency_table(stored: DataFrame) -> Table:
    """The shared table, of the counts over all documents: no more rows than ids reach the driver."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                one = np.frombuffer(raw, "<i8")
                if len(one) > len(total):
                    total = np.concatenate([total, np.zeros(len(one) - len(total), np.int64)])
                total[: len(one)] += one
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], names=["id", "n"])

    counts = stored.filter("histogram IS NOT NULL").select("histogram").mapInArrow(released(unpack), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return Table.of_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))


def write_shards(docs: DataFrame, folder: str, tokenizer: str, *, doc: str = "doc_id", text: str = "text", shard_bytes: int = 12 << 20, slab: int = 4 << 20) -> DataFrame:
    """Tokenize, write ``folder``, and give the manifest: part, seq, file, n_ids, start (ids in all shards before)."""
    from hexsite.llm._shared import stored

    spark = docs.sparkSession
    kept = stored(tokenized(docs, tokenizer, doc=doc, text=text, slab=slab), "token-ids")
    table = frequency_table(kept)
    write_atomically(f"{folder}/table.rans", packed := table.to_bytes())
    kind = kept.filter("ids IS NOT NULL").agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)).alias("b")).first()
    shards = max(1, -(-int(kind["b"]) // shard_bytes))
    shared = spark.sparkContext.broadcast(packed)  # at most eight bytes for each id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext
        from tokenizers import Tokenizer

        width = np.dtype("<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4")
        part, made = TaskContext.get().partitionId(), 0
        fs, at = open_fs(folder)
        freq = Table.from_bytes(shared.value)
        writer = own = out = None

        def close() -> pa.RecordBatch:
            nonlocal writer, made
            writer.close()
            out.close()
            name = own.rpartition("/")[2]
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([made], pa.int64()), pa.array([name]), pa.array([writer.n_ids], pa.int64())], names=["part", "seq", "file", "n_ids"])
            writer, made = None, made + 1
            return row

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    own = f"{at}/shard-{part:08d}-{made:05d}-{uuid.uuid4().hex}.rans"
                    out = fs.open_output_stream(own, compression=None)
                    writer = ShardWriter(out, freq)
                writer.add(doc_id, np.frombuffer(ids, width).astype(np.uint32))
                if writer.n_ids * width.itemsize >= 2 * shard_bytes:  # a range may hold more than its share
                    yield close()
        if writer is not None:
            yield close()

    ranged = kept.filter("ids IS NOT NULL").select("doc_id", "ids").repartitionByRange(partitions(shards), F.col("doc_id"), F.substring("ids", 1, 16)).sortWithinPartitions("doc_id", "ids")
    manifest = stored(ranged.mapInArrow(released(write), "part long, seq long, file string, n_ids long"), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, ids (array) of each document, from the files."""
    return _read(manifest, folder, "doc_id long, start long, ids array<long>", lambda ids: pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""
    got = _read(manifest, folder, "doc_id long, start long, d struct<n_tokens:long,ids_crc32:long>", lambda ids: pa.array([{"n_tokens": len(i), "ids_crc32": zlib.crc32(i.astype("<u4").tobytes())} for i in ids], pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])))
    return got.select("doc_id", "start", "d.n_tokens", "d.ids_crc32")


def _read(manifest: DataFrame, folder: str, schema: str, give) -> DataFrame:
    third = schema.split(", ")[2].split(" ")[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = open_fs(folder)
                if table is None:
                    with fs.open_input_stream(f"{at}/table.rans") as f:
                        table = Table.from_bytes(f.read())
                with fs.open_input_stream(f"{at}/{file}") as f:
                    raw = f.read()
                foot = shard_footer(raw)
                ids = shard_ids(raw, foot, table)
                docs = foot["docs"]
                for a in range(0, len(docs), 2000):
                    some = docs[a : a + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in some], pa.int64()), pa.array([start + s for _, s, _ in some], pa.int64()), give([ids[s : s + n] for _, s, n in some])], names=["doc_id", "start", third])

    return manifest.select("file", "start").repartition(partitions(manifest.count())).mapInArrow(released(read), schema)


def op6(docs: DataFrame, tokenizer: str, *, slab: int = 4 << 20) -> DataFrame:
    folder = shared_dir(docs.sparkSession, "tokens")
    return read_digests(write_shards(docs, folder, tokenizer, slab=slab), folder)

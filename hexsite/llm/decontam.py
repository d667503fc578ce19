"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items, one scan of each text.

A-Z are lower-cased and words are runs of letters, digits and non-ASCII characters. A window is ``window`` consecutive words
of an item; an item with fewer words, but not none, is one window. Items are cut into blocks of (window + 1) // 2 words,
side by side: every window holds one of them whole. The automaton's patterns are the blocks and the short items, so it has
about as many nodes as the items have bytes, not ``window`` times as many. It runs over the document's words joined by single
spaces; where a block occurs, words are compared on both sides, as far as a window that holds the block can reach, and
if ``window`` of them agree, those are hit. An offset is counted back to words and to code points of the original text.

Size: items are normalised and stored; an item of very many words is stored in pieces that overlap by a window less one.
An automaton holds the pieces of one part, of about ``most_bytes``, which bounds its nodes (some 55 bytes each); it is
built once in a Python worker and kept there for later batches and tasks. A benchmark of one part, the usual case, means that each
text is scanned once; one of several parts that texts are gathered up to HELD bytes and scanned once a part.

Defined results: null and empty texts have no words and no hits; texts of any length are scanned whole; an item without
words has no window; equal item_ids and repeated rows count once in an item list; a null item_id is an item of its own, written
as "null" in a list of ids; an empty benchmark leaves all documents clean. Equal ids and repeated documents each keep a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import FOLD, annotate, open_fs, released, shared_dir, small_batches, stored, utf8, words

PIECE, HELD = 50_000, 64 << 20
SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
FIELDS = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": SPAN}


def normalised(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, body, whole): pieces of PIECE words at most, joined by spaces, and whether the item is one piece; each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                w = words(t)
                starts = range(0, max(1, len(w) - window + 1), PIECE - window + 1) if w else ()
                out += [(name, b" ".join(w[a : a + PIECE]), len(w) <= PIECE) for a in starts]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.binary(), pa.bool_()), strict=True)], names=["item", "body", "whole"])

    small_batches(benchmark.sparkSession)
    source = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("body"))
    return source.mapInArrow(released(run), "item string, body binary, whole boolean").distinct()


class Scanner:
    """The automaton over the pieces (item, words joined by spaces, whole) of some items."""

    def __init__(self, pieces: list[tuple[str | None, bytes, bool]], window: int):
        import ahocorasick

        self.window, self.block = window, (window + 1) // 2
        self.number: dict[bytes, int] = {}
        flat, owner, found = [], [], {}
        gap = [-1] * window  # nothing agrees across the ends of pieces
        for name, body, whole in pieces:
            w = body.split()
            if whole and len(w) < window:
                found.setdefault(b" " + body + b" ", ([], set()))[1].add(name)
                continue
            base = len(flat) + window
            for o in range(0, len(w) - self.block + 1, self.block):
                found.setdefault(b" " + b" ".join(w[o : o + self.block]) + b" ", ([], set()))[0].append(base + o)
            flat += gap
            flat += [self.number.setdefault(x, len(self.number)) for x in w]
            owner.append((base, name))
        self.flat = np.array(flat + gap, np.int32)
        self.starts = np.array([a for a, _ in owner], np.int64)
        self.names = [n for _, n in owner]
        self.found = [(k.count(b" ") - 1, np.array(places, np.int64), names) for k, (places, names) in found.items()]
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, k in enumerate(found):
            self.machine.add_word(k.decode("latin-1"), i)
        if found:
            self.machine.make_automaton()

    def hits(self, w: list[bytes], line: str) -> list[tuple[int, int, set]]:
        """(first word, word after the last, items) of runs that hold windows, in the words and in `` w1 w2 ... ``."""
        ends = list(self.machine.iter(line)) if self.found else []
        if not ends:
            return []
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(spaces, [e for e, _ in ends])
        reach = self.window - self.block
        own = None
        out = []
        for stop, (_, i) in zip(last.tolist(), ends, strict=True):
            n, places, names = self.found[i]
            if names:
                out.append((stop - n, stop, names))
            if not len(places):
                continue
            if own is None:
                number = self.number.get
                own = np.full(len(w) + 2 * reach, -2, np.int32)
                own[reach : reach + len(w)] = [number(x, -2) for x in w]
            at = stop - n + reach
            before, after = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
            for count, step, first in ((before, -1, -1), (after, 1, n)):
                left = np.arange(len(places))
                for k in range(reach):
                    left = left[self.flat[places[left] + first + step * k] == own[at + first + step * k]]
                    if not len(left):
                        break
                    count[left] += 1
            for p in np.flatnonzero(before + n + after >= self.window):
                name = self.names[int(np.searchsorted(self.starts, places[p], side="right")) - 1]
                out.append((stop - n - int(before[p]), stop + int(after[p]), {name}))
        return out


_BUILT: dict[str, Scanner] = {}  #: the last automaton of this worker


def scanner(path: str, part: int, window: int) -> Scanner:
    """The automaton of a stored part; kept until another is asked for."""
    import pyarrow.dataset as ds

    key = f"{path}#{part}#{window}"
    if key not in _BUILT:
        _BUILT.clear()
        fs, at = open_fs(f"{path}/part={part}")
        got = ds.dataset(at, filesystem=fs, format="parquet").to_table(["item", "body", "whole"]).to_pydict()
        _BUILT[key] = Scanner(list(zip(got["item"], got["body"], got["whole"], strict=True)), window)
    return _BUILT[key]


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the original text."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[0], np.frombuffer(text.translate(FOLD), np.uint8) != 32, [0]]).astype(np.int8)
    step = np.diff(inside)
    begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"begin": int(point[begins[a]]), "end": int(point[ends[b - 1]])} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def scan_texts(texts: list[bytes], scanners) -> tuple[list, list, list, list]:
    """``scanners``: an iterable of Scanner; each sees every text once."""
    counts, hits, owners = [0] * len(texts), [None] * len(texts), [set() for _ in texts]
    for s in scanners:
        for i, t in enumerate(texts):
            w = words(t)
            counts[i] = len(w)
            if w and (found := s.hits(w, (b" " + b" ".join(w) + b" ").decode("latin-1"))):
                if hits[i] is None:
                    hits[i] = np.zeros(len(w) + 1, np.int64)
                np.add.at(hits[i], [a for a, _, _ in found], 1)
                np.add.at(hits[i], [b for _, b, _ in found], -1)
                owners[i].update(*[names for _, _, names in found])
    covered = [None if h is None else np.cumsum(h[:-1]) > 0 for h in hits]
    return (
        counts,
        [0 if c is None else int(c.sum()) for c in covered],
        [sorted(o, key=lambda x: ("null" if x is None else x, x is None)) for o in owners],
        [[] if c is None else _spans(t, c) for t, c in zip(texts, covered, strict=True)],
    )


def scan(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None, item: str = "item_id", item_text: str = "text", window: int = 10, most_bytes: int = 3 << 20) -> DataFrame:
    """``keep`` columns of each document as a struct, with n_words, n_hit, items (sorted as strings, null as one of its own) and hit spans."""
    pieces = stored(normalised(benchmark, item, item_text, window), "benchmark-pieces")
    total = int(pieces.select(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("b")).first()["b"])
    parts = -(-total // most_bytes)
    path = shared_dir(docs.sparkSession, "benchmark")
    pieces.withColumn("part", F.expr(f"pmod(xxhash64(item, body), {max(1, parts)})").cast("int")).repartition(max(1, parts), "part").write.partitionBy("part").parquet(path)

    def make():
        import pyarrow.fs as pafs

        fs, at = open_fs(path)
        there = [p for p in range(parts) if fs.get_file_info(f"{at}/part={p}").type != pafs.FileType.NotFound]
        again = Scanner([], window)  # counts words where there is no item
        order = [there]

        def of(texts: list[bytes]) -> tuple:
            out = scan_texts(texts, (scanner(path, p, window) for p in order[0]) if there else [again])
            order[0] = order[0][::-1]  # the part that was built last comes first
            return out

        return of

    return annotate(docs, text, docs.columns if keep is None else keep, FIELDS, make, gather=HELD if parts > 1 else 0)


def digest_items(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns: an item list is its SHA-256 in hex, of the comma-joined ids."""
    got = scan(docs, benchmark, keep=["doc_id"])
    return got.select(
        F.col("keep.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",", "null").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any hit, with the columns they came with."""
    return scan(docs, benchmark).filter("n_hit = 0").select("keep.*")


ORACLE_SQL = r"""
WITH norm AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
pat AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM pat),
pos AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM norm WHERE len(w) > 0),
win AS (SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM pos, lens WHERE i + n - 1 <= len(w)),
hit AS (SELECT r, i, win.n, item FROM win JOIN pat ON win.n = pat.n AND win.p = pat.p),
cov AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
own AS (SELECT r, count(*) AS n_items, string_agg(coalesce(item, 'null'), ',' ORDER BY coalesce(item, 'null')) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN cov USING (r) LEFT JOIN own USING (r)
"""

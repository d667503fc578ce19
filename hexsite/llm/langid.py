"""Language identification: unigram pieces of a fixed public vocabulary, summed over all segmentations.

Each language has a probability for each piece of the vocabulary. The probability of a word is the sum, over all ways
to cut it into pieces, of the product of their probabilities (forward algorithm); that of a text is the product over
its words, as pieces don't cross words. The prediction is the language with the highest sum of logarithms, its score
the posterior under equal priors.

Fitting: expected counts (forward-backward) over the words of the labelled rows that aren't held out, a few rounds,
mixed with the counts of all languages together. ``fit_bytes`` bounds the text used for each language and
``fit_bytes_all`` that of all: of a larger language, documents are taken in the order of a hash of their id until the
bound is reached, one at least; of a text longer than the bound only its beginning is learned from. Scoring reads every
whole text. The model has vocabulary x languages numbers.

Words are runs of letters, digits and non-ASCII characters in lower case. A word of any length is scored by the whole
forward sum: of long ones, such as text in scripts without spaces, the sums of the last places alone are kept, times a
factor for each language whose logarithm is carried along. (Only in fitting are runs of over LONGEST characters learned
from in parts.) Scores of words of up to KEPT bytes are cached, up to ``most`` words a task; new words are scored many at
a time.

Defined results: texts of any length are scored whole; null or empty texts, and texts without a letter, are ``und`` with score 0; so is everything if there
is no labelled row to learn from. Null languages aren't learned. Ties go to the language first by code point. A null
doc_id is neither held out nor learned from. Equal ids and repeated rows each keep their row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import FOLD, annotate, give_back, released, slices, utf8, words

LONGEST, FLOOR, KEPT = 24, 1e-7, 64
STEPS = 64  #: slots of the drawing hash for each doubling of it: the last slot taken has about a hundredth of the sample
FIELDS = {"lang_pred": pa.string(), "score": pa.float64()}


def parts_of(word: bytes) -> list[str]:
    """The strings learned from for a word, of LONGEST characters at most."""
    w = whole(word)
    return [w] if len(w) <= LONGEST else [w[i : i + LONGEST] for i in range(0, len(w), LONGEST)]


def whole(word: bytes) -> str:
    """The string scored for a word: a mark of its start and its characters in lower case."""
    return "▁" + word.decode("utf-8", "ignore").lower()


def beginning(text: bytes, most: int) -> bytes:
    """Whole characters of the first ``most`` bytes, without a word that is cut, unless it is the only one."""
    head = text[:most].decode("utf-8", "ignore").encode()
    whole = head.translate(FOLD).rpartition(b" ")[0]
    return whole or head


class Vocabulary:
    """The pieces, by number; in ``find`` also each proper prefix of a piece, as -1."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = sorted({p for p in pieces if len(p) <= LONGEST and "▁" not in p[1:]})
        self.n = len(pieces) + 1  # the last is any single character that isn't a piece
        self.longest = max(map(len, pieces), default=1)
        self.find = {p[:k]: -1 for p in pieces for k in range(1, len(p))} | {p: i for i, p in enumerate(pieces)}

    def edges(self, strings: list[str], low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(string, begin, end, piece) of each piece that fits somewhere and ends after ``low`` and not after ``high``, ordered by
        end and then string. Places are counted from ``low - longest``, or from 0 if that is less."""
        find, other = self.find.get, self.n - 1
        base = max(0, low - self.longest)
        out: list[int] = []
        put = out.append
        for k, s in enumerate(strings):
            n = len(s) if high is None else min(len(s), high)
            for i in range(base, n):
                at = k << 48 | i - base << 24
                single = False
                for j in range(i + 1, n + 1):
                    p = find(s[i:j])
                    if p is None:
                        break
                    if p >= 0:
                        if j > low:
                            put(at | j - base)
                            put(p)
                        single |= j == i + 1
                if not single and i + 1 > low:
                    put(at | (i + 1 - base))
                    put(other)
        flat = np.array(out, np.int64).reshape(-1, 2)
        k, i, j = flat[:, 0] >> 48, (flat[:, 0] >> 24) & 0xFFFFFF, flat[:, 0] & 0xFFFFFF
        order = np.lexsort((k, j))
        return k[order], i[order], j[order], flat[order, 1]


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of equal keys that stand together."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first, axis=0)


def forward(n: int, lengths: np.ndarray, edges: tuple, p: np.ndarray) -> np.ndarray:
    """alpha[string, place, language]: the probability of all segmentations of what stands before the place."""
    k, i, j, piece = edges
    alpha = np.zeros((n, int(lengths.max(initial=0)) + 1, p.shape[1]))
    alpha[:, 0] = 1.0
    cut = np.searchsorted(j, np.arange(alpha.shape[1] + 1))
    for place in range(1, alpha.shape[1]):
        a, b = cut[place], cut[place + 1]
        if a < b:
            who, total = _sum_by(k[a:b], alpha[k[a:b], i[a:b]] * p[piece[a:b]])
            alpha[who, place] = total
    return alpha


def scaled(vocabulary: Vocabulary, strings: list[str], p: np.ndarray, window: int | None = None) -> np.ndarray:
    """(strings, languages) of logarithms, for strings of any length: the forward sums, a window of places at a time.

    Only as many places as the longest piece are kept. Before they grow too small for a number they are multiplied, for
    each string and language by itself, and the logarithm of the factor is remembered."""
    n, span = len(strings), vocabulary.longest
    window = window or max(span, (1 << 17) // n)
    lengths = np.array([len(s) for s in strings])
    out, taken = np.empty((n, p.shape[1])), np.zeros((n, p.shape[1]))
    last = np.ones((n, 1, p.shape[1]))
    for low in range(0, int(lengths.max()), window):
        high = min(low + window, int(lengths.max()))
        base = max(0, low - span)
        k, i, j, piece = vocabulary.edges(strings, low, high)
        alpha = np.zeros((n, high - base + 1, p.shape[1]))
        alpha[:, : low - base + 1] = last[:, -(low - base + 1) :]
        cut = np.searchsorted(j, np.arange(low - base + 1, high - base + 2))
        for place in range(low - base + 1, high - base + 1):
            a, b = cut[place - low + base - 1], cut[place - low + base]
            who, total = _sum_by(k[a:b], alpha[k[a:b], i[a:b]] * p[piece[a:b]])
            alpha[who, place] = total
            if place % 8 == 0 or place == high - base:
                few = alpha[:, max(0, place - span) : place + 1]
                top = few.max(axis=1)
                factor = np.where((top > 0) & (top < 1e-100), top, 1.0)
                if (factor != 1).any():
                    few /= factor[:, None]
                    taken += np.log(factor)
        done = np.flatnonzero((lengths > low) & (lengths <= high))
        out[done] = np.log(alpha[done, lengths[done] - base]) + taken[done]
        last = alpha[:, -(span + 1) :]
    return out


def log_probabilities(vocabulary: Vocabulary, strings: list[str], p: np.ndarray) -> np.ndarray:
    """(strings, languages) of logarithms."""
    out = np.zeros((len(strings), p.shape[1]))
    lengths = np.array([len(s) for s in strings], np.int64)
    short = np.flatnonzero(lengths <= LONGEST)
    if len(short):
        some = [strings[i] for i in short]
        alpha = forward(len(some), lengths[short], vocabulary.edges(some), p)
        out[short] = np.log(alpha[np.arange(len(some)), lengths[short]])
    long = np.flatnonzero(lengths > LONGEST)
    long = long[np.argsort(lengths[long], kind="stable")]
    for a in range(0, len(long), 256):
        out[long[a : a + 256]] = scaled(vocabulary, [strings[i] for i in long[a : a + 256]], p)
    return out


def fit(vocabulary: Vocabulary, counts: dict[str, Counter], rounds: int = 3, strength: float = 2000.0) -> tuple[list[str], np.ndarray]:
    """Languages in order, and p[piece, language], by expected counts."""
    langs = sorted(counts)
    strings = sorted({s for c in counts.values() for s in c})
    if not strings:
        return [], np.zeros((vocabulary.n, 0))
    number = {s: i for i, s in enumerate(strings)}
    n = np.zeros((len(strings), len(langs)))
    for c, lang in enumerate(langs):
        for s, x in counts[lang].items():
            n[number[s], c] = x
    p = np.full((vocabulary.n, len(langs)), 1.0 / vocabulary.n)
    block = 8_000
    for _ in range(rounds):
        expected = np.zeros_like(p)
        for a in range(0, len(strings), block):
            some = strings[a : a + block]
            lengths = np.array([len(s) for s in some])
            edges = k, i, j, piece = vocabulary.edges(some)
            alpha = forward(len(some), lengths, edges, p)
            # the sums behind a place are the sums before it in the strings read backwards
            order = np.lexsort((k, lengths[k] - i))
            back = k[order], (lengths[k] - j)[order], (lengths[k] - i)[order], piece[order]
            beta = forward(len(some), lengths, back, p)
            share = alpha[k, i] * p[piece] * beta[k, lengths[k] - j] * (n[a : a + block] / alpha[np.arange(len(some)), lengths])[k]
            for c in range(len(langs)):
                expected[:, c] += np.bincount(piece, share[:, c], vocabulary.n)
        together = (expected.sum(axis=1) + 0.01) / (expected.sum() + 0.01 * vocabulary.n)
        p = np.maximum((expected + strength * together[:, None]) / (expected.sum(axis=0) + strength), FLOOR)
        p[-1] = FLOOR
    return langs, p


def has_letter(word: bytes) -> bool:
    return any(map(str.isalpha, word.decode("utf-8", "ignore")))


class Scorer:
    """Languages of texts under a fitted model."""

    def __init__(self, vocabulary: Vocabulary, langs: list[str], p: np.ndarray, most: int = 400_000):
        self.vocabulary, self.langs, self.p, self.most = vocabulary, langs, p, most
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.score = np.zeros((1024, len(self.langs)), np.float32)
        self.letter = np.zeros(1024, bool)

    def learn(self, new: set[bytes]) -> None:
        todo = list(new)
        for a in range(0, len(todo), 5_000):
            some = todo[a : a + 5_000]
            at = len(self.row)
            while at + len(some) > len(self.score):
                self.score = np.concatenate([self.score, np.zeros_like(self.score)])
                self.letter = np.concatenate([self.letter, np.zeros_like(self.letter)])
            self.score[at : at + len(some)] = log_probabilities(self.vocabulary, [whole(w) for w in some], self.p)
            self.letter[at : at + len(some)] = [has_letter(w) for w in some]
            self.row.update(zip(some, range(at, at + len(some)), strict=True))

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        if len(self.row) > self.most:
            self.clear()
        found = [words(t) for t in texts]
        new: set[bytes] = set()
        for w in found:
            new.update(w)
        long = [w for w in new if len(w) > KEPT]
        self.learn(new.difference(self.row, long))
        more = dict(zip(long, log_probabilities(self.vocabulary, [whole(w) for w in long], self.p), strict=True))
        names, scores = [], []
        for w in found:
            extra = [x for x in w if x in more] if more else []
            if extra:
                w = [x for x in w if x not in more]
            rows = np.fromiter(map(self.row.__getitem__, w), np.int64, len(w))
            if not self.letter[rows].any() and not any(map(has_letter, extra)):
                names.append("und")
                scores.append(0.0)
                continue
            total = self.score[rows].sum(axis=0, dtype=np.float64) + sum(more[x] for x in extra)
            best = int(total.argmax())
            names.append(self.langs[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return names, scores


def trained(docs: DataFrame, vocabulary: str, *, doc: str = "doc_id", text: str = "text", lang: str = "lang", fit_bytes: int = 1_500_000, fit_bytes_all: int = 12_000_000) -> tuple[list[str], np.ndarray]:
    """Fit on labelled rows whose CRC-32 of the id, as text, is not 2 modulo 4."""
    key = F.col(doc).cast("string")
    labelled = docs.select(key.alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter((F.crc32(key.cast("binary")) % 4 != 2) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("langid:"), "key").cast("binary")), 1, 8), 16, 10).cast("long")
    slot = F.floor(F.log2(draw + F.lit(1)) * STEPS).cast("int")
    labelled = labelled.select("lang", "text", slot.alias("slot"))
    held = labelled.groupBy("lang", "slot").agg(F.sum(F.least(F.octet_length("text"), F.lit(fit_bytes)).cast("long")).alias("b")).collect()  # 32 * STEPS rows a language at most
    langs = sorted({r["lang"] for r in held})
    bound = min(fit_bytes, fit_bytes_all // max(1, len(langs)))
    if not langs:
        return [], np.zeros((0, 0))
    last, taken = {}, dict.fromkeys(langs, 0)
    for r in sorted(held, key=lambda r: r["slot"]):
        if r["lang"] not in last or taken[r["lang"]] < bound:
            last[r["lang"]] = r["slot"]
            taken[r["lang"]] += r["b"]
    upto = F.create_map(*[F.lit(x) for kv in last.items() for x in kv])
    sample = labelled.filter(F.col("slot") <= F.element_at(upto, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t if len(t) <= bound else beginning(t, bound) for t in utf8(batch.column(1))]
            for a, b in slices(texts):
                got = Counter((n, s) for n, t in zip(names[a:b], texts[a:b], strict=True) for w in words(t) for s in parts_of(w))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got]), pa.array([s for _, s in got]), pa.array(got.values(), pa.int64())], names=["lang", "string", "n"])

    table = sample.mapInArrow(released(count), "lang string, string string, n long").groupBy("lang", "string").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = {k: Counter() for k in langs}
    for r in table.toLocalIterator():  # bounded by fit_bytes_all
        counts[r["lang"]][r["string"]] = r["n"]
    model = fit(Vocabulary(vocabulary), counts)
    del counts
    give_back()  # the driver lives on, too
    return model


def identified(docs: DataFrame, model: tuple[list[str], np.ndarray], vocabulary: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns as a struct, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages

    def make():
        return Scorer(Vocabulary(vocabulary), *shared.value).predict

    return annotate(docs, text, docs.columns if keep is None else keep, FIELDS, make)


def op8(docs: DataFrame, vocabulary: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("keep.doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identified(docs, trained(docs, vocabulary), vocabulary, keep=["doc_id"]).select(F.col("keep.doc_id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, vocabulary: str, *, least: float = 0.5) -> DataFrame:
    """Documents in a language that was learned, with the columns they came with: neither ``und`` nor a score under ``least``."""
    return identified(docs, trained(docs, vocabulary), vocabulary).filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("keep.*")

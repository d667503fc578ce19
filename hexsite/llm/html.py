"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: what stands between tags that begin or end a block. Each block is a vector of
its tag path (tags and words of class and id, hashed), its words (hashed) and a few measures (length, share of link
text, punctuation, digits, capitals, place). A bidirectional LSTM in numpy reads the whole sequence and labels every
block, so what stands before and after, over the whole page, counts. Blocks labelled as main text are joined.

Scripts, styles, the page's title, text fields, templates, comments and markup are no blocks. All other text is, whatever
element holds it, fallback contents and formulas too. Character references are decoded, white space within a block becomes
one space, and a line break is white space. Weights are trained by ``html_train`` on generated pages and stored beside
this file; they are fixed in size and shipped to the tasks.

Pages are batched by their number of blocks; the work is proportional to the blocks, and memory to a batch of pages. A
page of more than LONG blocks is read in parts, each direction handing its state from part to part, so the labels are
those of the whole page and only its texts are held at once.

Defined results: null, empty and wordless pages give an empty text; a page of any length is read whole; unclosed and
crossed tags are closed as far as needed; a comment, script, style, title or text field that is never closed goes on to
the end, as in browsers; ``<!-->`` is an empty comment; equal ids and repeated rows each keep a row; a null url stays null.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import released, slices, small_batches, utf8

PATHS, WORDS, MEASURES, HIDDEN, LONG = 128, 64, 8, 32, 4096
INPUTS = PATHS + WORDS + MEASURES
WEIGHTS = Path(__file__).with_name("html_weights.npz")

# Elements of HTML.
RAW = frozenset("script style title textarea".split())
DRAWN = frozenset("svg object iframe".split())  #: something stands there, so words don't touch across it
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
ALONE = frozenset("p h1 h2 h3 h4 h5 h6".split())
REPEATED = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?][^>]*+>", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
LETTERS = re.compile(r"[a-z]+")
DIGIT = re.compile(r"\d")
ENDING = frozenset(".!?…:;\"”»")


@lru_cache(65536)
def place_of(kind: str, size: int) -> int:
    return zlib.crc32(kind.encode()) % size


class Block:
    __slots__ = ("text", "path", "link")

    def __init__(self, text: str, path: list[int], link: int):
        self.text, self.path, self.link = text, path, link


@lru_cache(8192)
def _marks(tag: str, attributes: str) -> tuple[int, ...]:
    names = [w for v in NAMED.findall(attributes) for w in LETTERS.findall(v.lower())] if attributes else []
    return tuple(place_of(k, PATHS) for k in (f"<{tag}", *[f".{w}" for w in names]))


class Open:
    """The elements that are open, with how many there are of each tag and of each mark of the path."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[int, ...]]] = []
        self.tags: dict[str, int] = {}
        self.marks: dict[int, int] = {}

    def push(self, tag: str, marks: tuple[int, ...]) -> None:
        self.stack.append((tag, marks))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        for m in marks:
            self.marks[m] = self.marks.get(m, 0) + 1

    def pop(self) -> str:
        tag, marks = self.stack.pop()
        for held, keys in ((self.tags, (tag,)), (self.marks, marks)):
            for k in keys:
                if held[k] == 1:
                    del held[k]
                else:
                    held[k] -= 1
        return tag

    def close(self, tag: str) -> None:
        if tag in self.tags:
            while self.pop() != tag:
                pass

    def path(self) -> list[int]:
        return [*self.marks, place_of(f"^{self.stack[-1][0]}", PATHS)] if self.stack else []


def _after(page: str, tag: str, at: int) -> int:
    """Where an element without markup of its own ends, or the page; templates are counted, as they hold one another."""
    depth = 1
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else int(tag == "template")
        if not depth:
            return m.end()
    return at if tag == "template" else len(page)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order."""
    out: list[Block] = []
    inside = Open()
    held: list[str] = []
    linked: list[str] = []
    at = 0
    templates = True

    def flush() -> None:
        if held:
            if text := " ".join(entities.unescape("".join(held)).split()):
                link = len(" ".join(entities.unescape("".join(linked)).split())) if linked else 0
                out.append(Block(text, inside.path(), min(link, len(text))))
            held.clear()
            linked.clear()

    size = len(page)
    while at < size:
        m = TAG.search(page, at)
        end = size if m is None else m.start()
        if end > at:
            held.append(page[at:end])
            if "a" in inside.tags:
                linked.append(page[at:end])
        if m is None:
            break
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if not closing and (tag in RAW or (tag == "template" and templates)):
            end = _after(page, tag, at)
            templates = templates and not (tag == "template" and end == at)  # one that is never closed is passed over
            at = end
            held.append(" ")
            continue
        if tag in DRAWN:
            held.append(" ")
        if tag == "br":
            held.append(" ")
            linked.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            inside.close(tag)
            continue
        if tag in BLOCKS:
            while not ALONE.isdisjoint(inside.tags):
                inside.pop()
        elif tag == "a":
            inside.close("a")
        if (bounds := REPEATED.get(tag)) and tag in inside.tags:
            for k in range(len(inside.stack) - 1, -1, -1):
                if inside.stack[k][0] in bounds:
                    break
                if inside.stack[k][0] == tag:
                    inside.close(tag)
                    break
        if tag not in VOID and not attributes.endswith("/"):
            inside.push(tag, _marks(tag, attributes))
    flush()
    return out


class Hasher:
    """Places of words, by a bounded cache."""

    def __init__(self, most: int = 300_000):
        self.known, self.most = {}, most

    def __call__(self, text: str) -> list[int]:
        found = text.split()
        known = self.known
        try:
            return [known[w] for w in found]
        except KeyError:
            if len(known) > self.most:
                known.clear()
            for w in found:
                if w not in known:
                    known[w] = zlib.crc32("".join(filter(str.isalpha, w.lower())).encode()) % WORDS
            return [known[w] for w in found]


def vectors(page: list[Block], hasher: Hasher) -> np.ndarray:
    n = len(page)
    out = np.zeros((n, INPUTS), np.float32)
    rows, columns, sizes = [], [], np.empty(n)
    measures = np.zeros((n, MEASURES), np.float32)
    for i, b in enumerate(page):
        out[i, b.path] = 1
        w = hasher(b.text)
        sizes[i] = len(w)
        rows.append(len(w))
        columns += w
        t = b.text
        k = len(t)
        measures[i] = (np.log1p(len(w)), np.log1p(k) / 4, b.link / k, sum(map(t.count, ",.;!?")) / len(w), len(DIGIT.findall(t)) / k, t[-1] in ENDING, t[:1].isupper(), "©" in t or "(c)" in t)
    if n:
        row = np.repeat(np.arange(n), rows)
        counts = np.bincount(row * WORDS + np.array(columns, np.int64), minlength=n * WORDS).reshape(n, WORDS)
        out[:, PATHS : PATHS + WORDS] = counts / np.sqrt(np.maximum(sizes, 1))[:, None]
        out[:, PATHS + WORDS :] = measures
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Labeller:
    """The bidirectional LSTM; inputs (time, pages, INPUTS) with a mask of real blocks."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    def states(self, x: np.ndarray, mask: np.ndarray, side: str, start: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Hidden states in reading order of one direction, and the last state; padding passes the state on."""
        w = self.w
        steps, pages, _ = x.shape
        gates = (x.reshape(-1, x.shape[2]) @ w[side + "x"] + w[side + "b"]).reshape(steps, pages, 4 * HIDDEN)
        h, c = start or (np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32))
        out = np.empty((steps, pages, HIDDEN), np.float32)
        for t in range(steps):
            g = gates[t] + h @ w[side + "h"]
            gate = sigmoid(g[:, : 3 * HIDDEN])
            new = gate[:, HIDDEN : 2 * HIDDEN] * c + gate[:, :HIDDEN] * np.tanh(g[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c = np.where(m, new, c)
            h = np.where(m, gate[:, 2 * HIDDEN :] * np.tanh(new), h)
            out[t] = h
        return out, (h, c)

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(time, pages): over 0 is main text."""
        ahead = self.states(x, mask, "f")[0]
        back = self.states(x[::-1], mask[::-1], "b")[0][::-1]
        return ahead @ self.w["of"] + back @ self.w["ob"] + self.w["o"]

    def long(self, page: list[Block], hasher: Hasher, most: int = LONG) -> np.ndarray:
        """Labels of one page of many blocks, ``most`` at a time: vectors are made once for each direction."""
        cuts = [(a, min(a + most, len(page))) for a in range(0, len(page), most)]
        score = np.full(len(page), self.w["o"][0], np.float32)
        for side, order, step in (("f", cuts, 1), ("b", cuts[::-1], -1)):
            state = None
            for a, b in order:
                x = vectors(page[a:b], hasher)[::step, None]
                states, state = self.states(x, np.ones((b - a, 1), bool), side, state)
                score[a:b] += (states[:, 0] @ self.w["o" + side])[::step]
        return score > 0

    def label(self, pages: list[np.ndarray], cells: int = 8192) -> list[np.ndarray]:
        """A boolean for each block of each page, many pages of like length at once."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= cells:
                end += 1
            some = order[at:end]
            steps = len(pages[some[-1]])
            x, mask = np.zeros((steps, len(some), INPUTS), np.float32), np.zeros((steps, len(some)), bool)
            for k, i in enumerate(some):
                x[: len(pages[i]), k] = pages[i]
                mask[: len(pages[i]), k] = True
            found = self.scores(x, mask) > 0
            for k, i in enumerate(some):
                out[i] = found[: len(pages[i]), k]
            at = end
        return out


def load(path: Path = WEIGHTS) -> dict[str, np.ndarray]:
    with np.load(path) as f:
        return {k: f[k] for k in f.files}


def extract(pages: list[str], labeller: Labeller, hasher: Hasher) -> list[str]:
    found = [blocks_of(p) for p in pages]
    short = [i for i, b in enumerate(found) if len(b) <= LONG]
    labels = dict(zip(short, labeller.label([vectors(found[i], hasher) for i in short]), strict=True))
    labels = [labels[i] if i in labels else labeller.long(b, hasher) for i, b in enumerate(found)]
    return ["\n\n".join(b.text for b, keep in zip(own, label, strict=True) if keep) for own, label in zip(found, labels, strict=True)]


def main_text(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html", weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(load() if weights is None else weights)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, hasher = Labeller(shared.value), Hasher()
        for batch in batches:
            for a, b in slices(utf8(batch.column(2)), 2 << 20):
                some = batch.slice(a, b - a)
                texts = extract([h or "" for h in some.column(2).to_pylist()], labeller, hasher)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    small_batches(pages.sparkSession)
    return pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")).mapInArrow(released(run), "page_id long, url string, text string, n_chars long")


def op10(pages: DataFrame) -> DataFrame:
    return main_text(pages)

"""N-gram Jaccard join: a MinHash LSH forest, then exact verification of whole shingle sets.

Words as in decontamination; shingles are ``words_each`` consecutive words (all words of a shorter text). Texts with
equal shingle sets are one node from the start, so copies are never paired.

Forest: a node's signature gives each of TREES prefix tries a label of DEEPEST values of its own. The labels of each trie
are sorted over all partitions; a label's longest common prefix with its neighbours is how deep the node matches there.
Matched prefixes are shortened for each node by itself: one that matches in few tries is looked up at long prefixes, one
that matches in many at shorter ones, down to the depth that is enough for every node. ``depths`` chooses the longest
prefixes for which the chance to miss a pair at the threshold, summed over all outcomes, stays under 1 - ``recall``.
Where a trie's nodes meet, they are walked from whole labels up; nodes whose signatures agree in a share of at least
``estimate`` (five standard errors under the threshold) are tied by a spanning forest, so that a group of m nodes gives
fewer than m ties and what is tied at a longer prefix isn't compared again. A group of more than GROUP nodes is salted;
delegates that cover each part then meet, in pairs of blocks of GROUP. Ties make candidate components.

Verification: texts of components are read again, and pairs are compared by whole shingle sets, in blocks of at most
about BLOCK shingles and NODES nodes; a large component becomes blocks of nodes of like size, and pairs of blocks, over
many tasks: blocks whose sizes differ too much to reach the threshold never meet. A task counts links and gives one tie
a node; pairs are never written. Ties of verified links make the classes.

Defined results: null texts and texts without words link to nothing, each with its own class. Sets that are too small
for any other set to be near enough are linked with their equals only. Equal ids or repeated rows each keep a row; a
class's name is the least doc_id in it, nulls aside. Texts of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import annotate, hash_words, mix, released, stored, words
from hexsite.operators.graph import components, joined_by_size

TREES, DEEPEST = 24, 8
VALUES = TREES * DEEPEST
GROUP, BLOCK, NODES = 8192, 1_000_000, 512
_DRAW = np.random.default_rng(20240229)
FACTORS = (_DRAW.integers(1, 1 << 31, VALUES) * 2 + 1).astype(np.uint32)
TERMS = _DRAW.integers(0, 1 << 32, VALUES).astype(np.uint32)


def floor_for(threshold: float, recall: float) -> int:
    """The longest prefix that reaches the recall for whatever node; at the least one value."""
    return next((d for d in range(DEEPEST, 1, -1) if 1 - (1 - threshold**d) ** TREES >= recall), 1)


def missed(threshold: float, shortest: int, depth: list[int]) -> float:
    """Chance that a pair at the threshold isn't met, if a node that matches in m tries, to ``shortest`` values at least, is
    looked up at ``depth[m]``. Matches with other nodes only add to m, and ``depth`` doesn't grow, so this is the most."""
    p = threshold**shortest
    return sum(comb(TREES, m) * (1 - p) ** (TREES - m) * (p - threshold ** depth[m]) ** m for m in range(TREES + 1))


def depths(threshold: float, recall: float) -> tuple[int, list[int]]:
    """(shortest prefix that counts as a match, prefix looked up by the number of tries with a match)."""
    floor = floor_for(threshold, recall)
    shortest = max(1, floor - 1)
    out = [DEEPEST] + [floor] * TREES
    for m in range(1, TREES + 1):
        out[m] = next(d for d in range(out[m - 1], floor - 1, -1) if d == floor or missed(threshold, shortest, [*out[:m], d, *out[m + 1 :]]) <= 1 - recall)
    return shortest, out


class Shingler:
    """Sets of 64-bit shingle hashes, as sorted arrays."""

    def __init__(self, words_each: int):
        self.n, self.cache = words_each, {}
        self.odd = (np.random.default_rng(7).integers(1, 1 << 62, words_each) * 2 + 1).astype(np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        h = hash_words(words(text), self.cache)
        if not len(h):
            return h
        n = min(self.n, len(h))
        total = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            total += h[i : len(h) - n + 1 + i] * self.odd[i]
        return np.unique(mix(total + np.uint64(n)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, VALUES) least values of linear permutations of 32 bits; sets must not be empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), VALUES), np.uint32)
    for v in range(VALUES):
        out[:, v] = np.minimum.reduceat(flat * FACTORS[v] + TERMS[v], first)
    return out


def described(docs: DataFrame, doc: str, text: str, words_each: int) -> DataFrame:
    """doc_id, a hash of the text, digest of the shingle set (null: no words), its size, the trees' labels and a byte of each value."""
    from xxhash import xxh3_128_digest

    fields = {"digest": pa.binary(), "n": pa.int32(), "labels": pa.list_(pa.binary()), "brief": pa.binary()}

    def make():
        shingles = Shingler(words_each)

        def of(texts: list[bytes]) -> tuple:
            sets = [shingles(t) for t in texts]
            there = [i for i, s in enumerate(sets) if len(s)]
            out = [[None] * len(texts), [len(s) for s in sets], [None] * len(texts), [None] * len(texts)]
            for a in range(0, len(there), 64):
                some = there[a : a + 64]
                found = signatures([sets[i] for i in some])
                labels = (found >> np.uint32(16)).astype(">u2").reshape(len(some), TREES, DEEPEST)
                for i, label, brief in zip(some, labels, found.astype(np.uint8), strict=True):
                    out[0][i] = xxh3_128_digest(sets[i].tobytes())
                    out[2][i] = [x.tobytes() for x in label]
                    out[3][i] = brief.tobytes()
            return tuple(out)

        return of

    source = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"))
    return annotate(source, "text", ["doc_id", "mark"], fields, make).select("keep.doc_id", "keep.mark", *fields)


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of equal leading columns, from a partition sorted by them."""
    key, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        names = batch.schema.names[n_keys:]
        for row in zip(*columns, strict=True):
            if row[:n_keys] != key:
                if held:
                    yield key, dict(zip(names, map(list, zip(*held, strict=True)), strict=True))
                key, held = row[:n_keys], []
            held.append(row[n_keys:])
    if held:
        yield key, dict(zip(names, map(list, zip(*held, strict=True)), strict=True))


def spanning(briefs: np.ndarray, least: float, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Ties that connect whatever agrees in a share of ``least`` or more; fewer than nodes. Nodes of one ``label``, which is
    brought up to date, are tied already."""
    n = len(briefs)
    label, ties = np.arange(n) if label is None else label, []
    need = least * briefs.shape[1]
    for i in range(n - 1):
        rest = np.flatnonzero(label != label[i])
        if not len(rest):
            break
        rest = rest[rest > i]
        near = rest[(briefs[rest] == briefs[i]).sum(axis=1) >= need]
        if len(near):
            other, at = np.unique(label[near], return_index=True)
            ties += [(i, int(j)) for j in near[at]]
            label[np.isin(label, other)] = label[i]
    return ties


def delegates(briefs: np.ndarray, least: float) -> list[int]:
    """Nodes such that every node agrees with one of them in a share of ``least`` or more."""
    left, out = np.arange(len(briefs)), []
    while len(left):
        out.append(int(left[0]))
        left = left[(briefs[left] == briefs[left[0]]).sum(axis=1) < least * briefs.shape[1]]
    return out


def common(labels: np.ndarray) -> np.ndarray:
    """Values that each label (rows of DEEPEST values) has in common with the one before; one less than rows."""
    return np.logical_and.accumulate(labels[1:] == labels[:-1], axis=1).sum(axis=1)


def walk(labels: np.ndarray, depth: np.ndarray, briefs: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Ties of a part of a trie, its labels sorted: from whole labels to the shortest prefix that one of the nodes is looked up at."""
    n = len(labels)
    shared, label, ties = common(labels), np.arange(n), []
    for d in range(DEEPEST, int(depth.min()) - 1, -1):
        edge = np.flatnonzero(np.concatenate([[True], shared < d, [True]]))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if b - a > 1 and depth[a:b].min() <= d:
                ties += [(a + i, a + j) for i, j in spanning(briefs[a:b], least, label[a:b])]  # brings that part of label up to date
    return ties


def _tied(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["a", "b", "key", "brief"])


def matches(nodes: DataFrame, shortest: int) -> DataFrame:
    """(digest, tree, label, deep): labels that share at least ``shortest`` values with another of their trie, and the most
    they share. All labels are sorted; the first and the last of a partition, whose neighbour isn't there, count as matched."""
    spread = nodes.select("digest", F.posexplode("labels").alias("tree", "label"))
    ranged = spread.repartitionByRange("tree", "label", "digest").sortWithinPartitions("tree", "label", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, DEEPEST

        def found(rows: pa.RecordBatch, shares: np.ndarray) -> pa.RecordBatch:
            keep = np.flatnonzero(shares >= shortest)
            some = rows.take(pa.array(keep))
            return pa.RecordBatch.from_arrays([*some.columns, pa.array(shares[keep], pa.int32())], names=["digest", "tree", "label", "deep"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            labels = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint16).reshape(-1, DEEPEST)
            tree = rows.column(1).to_numpy()
            shared = np.where(tree[1:] == tree[:-1], common(labels), 0)
            if len(shared):
                yield found(rows.slice(0, len(shared)), np.maximum(np.concatenate([[before], shared[:-1]]), shared))
                before = int(shared[-1])
            held = rows.slice(rows.num_rows - 1)
        if held is not None:
            yield found(held, np.array([DEEPEST]))

    return stored(ranged.mapInArrow(released(run), "digest binary, tree int, label binary, deep int"), "forest-matches")


def candidate_ties(nodes: DataFrame, threshold: float, recall: float, estimate: float) -> DataFrame:
    """(a, b) ties between nodes (digest, labels, brief) that share a prefix one of them is looked up at and nearly agree."""
    shortest, depth = depths(threshold, recall)
    found = matches(nodes, shortest)
    floor = min(depth)
    looked = found.groupBy("digest").agg(F.count(F.lit(1)).alias("m")).select("digest", F.element_at(F.array(*map(F.lit, depth)), F.col("m").cast("int") + 1).alias("depth"))
    keyed = found.filter(F.col("deep") >= floor).select("digest", "label", F.xxhash64("tree", F.substring("label", 1, 2 * floor)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = keyed.join(sizes.hint("merge"), "key")  # the plan of large inputs at every size
    salts = F.ceil(F.col("size") / F.lit(GROUP)).cast("int")
    briefs = nodes.select("digest", "brief").join(looked.hint("merge"), "digest")
    met = shared.join(briefs.hint("merge"), "digest").select("key", F.pmod(F.xxhash64("digest", "key"), salts).cast("int").alias("salt"), salts.alias("salts"), "label", "digest", "depth", "brief")

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (key, _, salts), got in _groups(batches, 3):
            digests = got["digest"]
            briefs = np.frombuffer(b"".join(got["brief"]), np.uint8).reshape(len(digests), VALUES)
            labels = np.frombuffer(b"".join(got["label"]), np.uint16).reshape(len(digests), DEEPEST)
            out += [(digests[i], digests[j], None, None) for i, j in walk(labels, np.array(got["depth"]), briefs, estimate)]
            if salts > 1:
                out += [(digests[i], None, key, got["brief"][i]) for i in delegates(briefs, 0.85)]
            if len(out) > 5000:
                yield _tied(out)
                out = []
        if out:
            yield _tied(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, got in _groups(batches, 3):
            digests = got["digest"]
            briefs = np.frombuffer(b"".join(got["brief"]), np.uint8).reshape(len(digests), VALUES)
            out += [(digests[i], digests[j], None, None) for i, j in spanning(briefs, estimate - 0.3)]
            if len(out) > 5000:
                yield _tied(out)
                out = []
        if out:
            yield _tied(out)

    schema = "a binary, b binary, key long, brief binary"
    first = stored(met.repartition("key", "salt").sortWithinPartitions("key", "salt", "label", "digest").mapInArrow(released(tie), schema), "forest-ties")
    late = first.filter("b IS NULL").select("key", F.col("a").alias("digest"), "brief")
    blocks = late.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP // 2)).cast("int").alias("blocks"))
    own = late.join(blocks.hint("merge"), "key").withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "digest", "brief")
    # stored, so that no task runs two Python workers at once: this one and that of the components
    second = stored(pairs.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "digest").mapInArrow(released(meet), schema), "forest-meetings")
    return first.filter("b IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, parts: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least parts[0] / parts[1], exactly."""
    both = left + (right or [])
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    flat = np.concatenate(both)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    n, split = len(left), 0 if right is None else len(left)
    common = np.zeros((n, len(both) - split), np.float32)
    width = int(often.sum())
    for a in range(0, width, 4096):
        x, y = np.searchsorted(column, [a, a + 4096])
        dense = np.zeros((len(both), min(4096, width - a)), np.float32)
        dense[owner[x:y], column[x:y] - a] = 1
        common += dense[:n] @ dense[split:].T
    size = np.array([len(s) for s in both], np.int64)
    top, bottom = parts
    found = common.astype(np.int64) * (top + bottom) >= top * (size[:n, None] + size[None, split:])
    if right is None:
        np.fill_diagonal(found, False)
    return found


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows without repeats of their first four columns: a text that was logged often under one id is held once."""
    last = None
    for batch in batches:
        keys = list(zip(*[c.to_pylist() for c in batch.columns[:4]], strict=True))
        keep = [k != before for k, before in zip(keys, [last, *keys[:-1]], strict=True)]
        last = keys[-1] if keys else last
        yield batch.filter(pa.array(keep, pa.bool_()))


def verified(docs: DataFrame, members: DataFrame, doc: str, text: str, words_each: int, parts: tuple[int, int]) -> DataFrame:
    """digest, links (rows of other nodes that are near enough), root: a node of the same class, from exact comparison.

    ``members``: component, digest, n, copies, doc_id and mark of one text for each node.
    """
    top, bottom = parts
    # sets whose sizes are two steps apart can't be near enough, so only neighbouring steps meet
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(bottom / top)) + 1e-9)).cast("int") if top < bottom else F.col("n")
    stepped = members.withColumn("step", step)
    cut = F.greatest(F.ceil(F.sum("n") / F.lit(BLOCK)), F.ceil(F.count(F.lit(1)) / F.lit(NODES))).cast("int")
    each = stepped.groupBy("component", "step").agg(cut.alias("blocks"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("nodes"))
    # an entry for each step of size, some hundred at most
    whole = each.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("step", "blocks"))).alias("blocks"), F.sum("total").alias("total"), F.sum("nodes").alias("nodes"))
    one = (F.col("total") <= BLOCK) & (F.col("nodes") <= NODES)
    whole = whole.select("component", "nodes", one.alias("one"), F.when(one, F.create_map(F.lit(0), F.lit(1))).otherwise(F.col("blocks")).alias("blocks"))
    placed = joined_by_size(stepped, "component", whole, "nodes", members.count()).withColumn("step", F.when(F.col("one"), 0).otherwise(F.col("step")))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("digest"), F.element_at("blocks", F.col("step"))).cast("int"))
    there = lambda k: F.transform(F.sequence(F.lit(0), F.coalesce(F.try_element_at("blocks", F.col("step") + k), F.lit(0)) - 1), lambda x: F.struct((F.col("step") + k).alias("s"), x.alias("b")))
    some = lambda k: F.when(F.try_element_at("blocks", F.col("step") + k) > 0, there(k)).otherwise(F.array().cast("array<struct<s:int,b:int>>"))
    blocked = placed.withColumn("meets", F.concat(some(-1), some(0), some(1)))
    texts = docs.select(F.col(f"`{doc}`").alias("d"), F.xxhash64(F.col(f"`{text}`")).alias("m"), F.col(f"`{text}`").alias("text"))
    with_text = texts.join(blocked.hint("merge"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark"))).select("text", "component", "digest", "copies", "step", "block", "meets")
    shape = "component binary, lo string, hi string, digest binary, side int, copies long, shingles binary"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingles = Shingler(words_each)
        kinds = (pa.binary(), pa.string(), pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.binary())
        names = ["component", "lo", "hi", "digest", "side", "copies", "shingles"]
        for batch in batches:
            out, held = [], 0
            for t, component, digest, copies, step, block, meets in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                s = shingles((t or "").encode()).tobytes()
                if xxh3_128_digest(s) != digest:
                    continue  # another text with the same id and hash
                own = (step, block)
                for m in meets:
                    other = (m["s"], m["b"])
                    out.append((component, str(min(own, other)), str(max(own, other)), digest, int(own > other), copies, s))
                    held += len(s)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (_, lo, hi), got in _groups(_once(batches), 3):
            once = {d: (side, copies, s) for d, side, copies, s in zip(got["digest"], got["side"], got["copies"], got["shingles"], strict=True)}
            nodes = sorted(once, key=lambda d: (once[d][0], d))
            sets = [np.frombuffer(once[d][2], np.uint64) for d in nodes]
            copies = np.array([once[d][1] for d in nodes])
            n = len(nodes) if lo == hi else sum(once[d][0] == 0 for d in nodes)
            if len(nodes) < 2 or not n or (lo != hi and n == len(nodes)):
                continue
            near = linked(sets[:n], None if lo == hi else sets[n:], parts)
            if lo == hi:
                links = near @ copies
                full = near
            else:
                links = np.concatenate([near @ copies[n:], copies[:n] @ near])
                full = np.zeros((len(nodes), len(nodes)), bool)
                full[:n, n:], full[n:, :n] = near, near.T
            root = np.arange(len(nodes))
            for i in range(len(nodes)):
                if root[i] == i and links[i]:
                    front, seen = np.array([i]), np.zeros(len(nodes), bool)
                    seen[i] = True
                    while len(front):
                        front = np.flatnonzero(full[front].any(axis=0) & ~seen)
                        seen[front] = True
                    root[seen] = i
            out += [(nodes[i], int(links[i]), nodes[root[i]]) for i in range(len(nodes)) if links[i]]
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["digest", "links", "root"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["digest", "links", "root"])

    pieces = with_text.mapInArrow(released(spread), shape).repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "digest")
    return pieces.mapInArrow(released(compare), "digest binary, links long, root binary")


def joined(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", words_each: int = 5, threshold: tuple[int, int] = (4, 5), recall: float = 0.999) -> DataFrame:
    """doc_id, class_id, n_links (rows with a similarity of at least the threshold, itself aside)."""
    t = threshold[0] / threshold[1]
    estimate = t - 5 * (t * (1 - t) / VALUES) ** 0.5
    top, bottom = threshold
    least = -(-top // (bottom - top)) if top < bottom else np.iinfo(np.int32).max  # smaller sets have no near one but their equals
    sets = stored(described(docs, doc, text, words_each), "shingle-sets")
    nodes = stored(
        sets.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("row"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("labels").alias("labels"), F.first("brief").alias("brief"))
        .select("digest", "row.doc_id", "row.mark", "copies", "n", "labels", "brief"),
        "shingle-nodes",
    )
    candidates = components(candidate_ties(nodes.filter(F.col("n") >= int(least)), t, recall, estimate))
    members = stored(candidates.select(F.col("node").alias("digest"), "component").join(nodes.drop("labels", "brief"), "digest"), "candidates")
    found = stored(verified(docs, members, doc, text, words_each, threshold), "verified")
    classes = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    labelled = (
        nodes.select("digest", "doc_id", "copies")
        .join(classes.withColumnRenamed("node", "digest"), "digest", "left")
        .join(links, "digest", "left")
        .select("digest", "doc_id", F.coalesce("component", "digest").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    names = labelled.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    of_digest = labelled.join(names, "class").select(F.col("digest").alias("g"), "class_id", "n_links")
    return sets.select("doc_id", "digest").join(of_digest.hint("merge"), F.col("digest") == F.col("g"), "left").select("doc_id", F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op2(docs: DataFrame) -> DataFrame:
    return joined(docs)


def deduplicated(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that with the least id (null: last), with the columns it came with; repeated rows stay once.

    A row is known by its id and two 64-bit hashes of its text: ids may be null, or equal on different texts.
    """
    t = F.col(f"`{text}`")
    row = F.struct(F.col(f"`{doc}`").isNull().alias("no"), F.col(f"`{doc}`").alias("id"), F.xxhash64(t).alias("h"), F.xxhash64(F.lit(7), t).alias("h7"))
    classes = joined(docs.select(row.alias("row"), t.alias("text")), doc="row")
    stay = stored(classes.filter(F.col("doc_id") == F.col("class_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "class-firsts").withColumnRenamed("doc_id", "stays")
    once = docs.join(stay.filter("rows = 1").select("stays").hint("merge"), row.eqNullSafe(F.col("stays")), "left_semi")
    again = docs.join(stay.filter("rows > 1").select("stays"), row.eqNullSafe(F.col("stays")), "left_semi")
    return once.unionByName(again.dropDuplicates([doc, text]))


ORACLE_SQL = r"""
WITH RECURSIVE norm AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM norm WHERE len(w) > 0)),
sized AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM pairs JOIN sized p ON p.r = x JOIN sized q ON q.r = y WHERE 9 * c >= 4 * (p.n + q.n)),
reach AS (SELECT r AS x, r AS y FROM norm UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT norm.doc_id, (SELECT min(o.doc_id) FROM reach JOIN norm o ON o.r = reach.y WHERE reach.x = norm.r) AS class_id,
       CAST((SELECT count(*) FROM links WHERE links.x = norm.r) AS BIGINT) AS n_links
FROM norm
"""

"""Connected components of a graph of any size, by forests in partitions and then alternating large and small stars.

First each partition replaces its edges by stars of what they connect, a bounded number of edges at a time, so that most
of the work is done before anything is shuffled. Then rounds: every neighbour above a node moves to the least of its
neighbourhood (large star), and what is below a node, and the node, is tied to the least of them (small star). They end
when the edges no longer change: each node hangs on the least node of its component. Rounds grow with the logarithm of
the size; each is stored in the shared folder, so the plan stays short and lost executors cost nothing. Minima are
aggregated before they are shuffled. A hub, a node with over a HUBS-th of the edges, isn't shuffled to its minimum: there
are fewer than 2 * HUBS of them, whatever the graph, so their minima are sent to the edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hexsite.sources.shared import stored

AT_ONCE, HUBS = 1 << 18, 500


def labels_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least number of each node's component, for edges between numbers under ``n``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        if (new == label).all():
            return label
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars that connect what the edges connect: fewer edges than nodes, for every AT_ONCE edges at the most."""

    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        lo, hi = rows.column(0).combine_chunks(), rows.column(1).combine_chunks()
        both = pa.concat_arrays([x if isinstance(x, pa.Array) else x.chunk(0) for x in (lo, hi)])
        coded = both.dictionary_encode()
        names = coded.dictionary
        order = pa.compute.sort_indices(names).to_numpy()
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        place = rank[coded.indices.to_numpy()]
        label = labels_of(place[: len(lo)], place[len(lo) :], len(names))
        node = np.flatnonzero(label != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([names.take(pa.array(order[label[node]])), names.take(pa.array(order[node]))], names=["lo", "hi"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= AT_ONCE:
            held = [stars(held)]
            size = held[0].num_rows
            if size >= AT_ONCE // 2:
                yield from held
                held, size = [], 0
    if size:
        yield stars(held)


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and a mark of them (count and a sum of hashes) taken while they are written."""
    seen = Observation()
    marked = edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(lo, hi))").alias("x"))
    out = stored(marked, "components")
    return out, (seen.get["n"], seen.get["x"])


def joined_by_size(left: DataFrame, key: str, right: DataFrame, size: str, n: int) -> DataFrame:
    """Inner join of ``left`` (about ``n`` rows) with ``right``, one row a ``key``, whose column ``size`` says how many rows of
    left have the key. Keys of over an n/HUBS-th are sent to the rows: there are fewer than 2 * HUBS; the others are joined by sorting."""
    hub = F.col(size) > max(n // HUBS, 64)
    rest = [c for c in right.columns if c != key]
    hubs = right.filter(hub).select(F.col(key).alias("_k"), F.struct(*rest).alias("_r"))
    met = left.join(F.broadcast(hubs), F.col(key) == F.col("_k"), "left")  # fewer than 2 * HUBS rows
    few = met.filter("_k IS NULL").drop("_k", "_r").join(right.filter(~hub).hint("merge"), key)
    return few.unionByName(met.filter("_k IS NOT NULL").select(*left.columns, "_r.*"))


def _with_least(edges: DataFrame, at: str, least: DataFrame, n: int) -> DataFrame:
    """Edges with ``to``, the least of the node in column ``at``; ``least`` has (at, to, c), and c says how many edges."""
    return joined_by_size(edges, at, least.withColumnRenamed("at", at), "c", n).select("lo", "hi", "to")


def components(edges: DataFrame, a: str = "a", b: str = "b", *, most_rounds: int = 60) -> DataFrame:
    """(node, component) for each node on an edge; a component's name is its least node. Loops and nulls are left out."""
    x, y = F.col(a), F.col(b)
    plain = edges.filter(x != y).select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))
    now, mark = _round(plain.mapInArrow(_forest, plain.schema))
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy(F.col("lo").alias("at")).agg(F.least(F.min("hi"), F.first("lo")).alias("to"), F.count(F.lit(1)).alias("c"))
        large = _with_least(now, "lo", least, mark[0]).select(F.col("to").alias("lo"), "hi").distinct()
        least = large.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("to"), F.count(F.lit(1)).alias("c"))
        tied = _with_least(large, "hi", least, mark[0])
        small = tied.filter(F.col("lo") != F.col("to")).select(F.col("to").alias("lo"), F.col("lo").alias("hi")).unionByName(least.select(F.col("to").alias("lo"), F.col("at").alias("hi")))
        before = mark
        now, mark = _round(small)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components are still changing after {most_rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())

"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Targets: the sources, by code point with null last, weigh 5, 2, 1, 5, ... and share ``share`` times all sizes. A
target stops at ``most`` times its source's size; the excess goes to the others by weight until none is above. With
caps c and weights w that is min(c, L w) for the L at which the sum is the budget; the sum is the least over the sets
of capped sources ordered by c / w, so L is a maximum over prefix sums of that order: one window over a row a source.

Systematic sampling: each document of a source is expected target / size times. Prefix sums of that over the source's
documents, plus one offset drawn for the source from the seed, cross some integers; a document is taken once for each
integer that it crosses. Documents stand in the order of (bits of their size, MD5 of seed and id): sizes are spread evenly over the
sample, so the words taken come near the target, and a document is taken at most ceil(most) times.

Scale: no window holds a source. Documents fall into cells (source, bits of the size, range of MD5); the number of
ranges follows the largest such pair, so a cell has about ``cell_rows`` rows, and a SHARES-th of all, whatever a hot source holds. Ranks inside
cells and prefix sums over the cells' counts give the place in the source.

Defined results: a null or empty text has size 0 and is taken 0 words; a text of any length is counted whole; a null source
is a source of its own; equal ids and repeated rows each have a place, in one cell; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.llm._shared import stored

WEIGHTS = (5, 2, 1)
SEED = "mix-1"
SHARES = 256  #: a cell has about this part of all rows, or ``cell_rows``, whatever is less


def words_of(text: Column) -> Column:
    """Number of runs of characters other than space and the controls 9-13, by counting spaces: no word is made a value."""
    line = text
    for c in "\t\n\x0b\x0c\r":
        line = F.replace(line, F.lit(c), F.lit(" "))
    line = F.trim(line)
    line = F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " {2,}", " ")).otherwise(line)
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(line == "", 0).otherwise(spaces + 1), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target of a frame of (source, source_size) with a row a source."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))  # a row a source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.expr(f"cast((n - 1) % {len(weights)} + 1 as int)"))
    ranked = sizes.withColumn("n", F.row_number().over(by_name)).withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("n"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    return ranked.withColumn("level", level).withColumn("level", F.max("level").over(everyone)).select("source", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _rank_value(hexes: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(hexes, 1, 8), 16, 10).cast("long")


def mixed(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", source: str = "source", share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, cell_rows: int = 32768, keep_rows: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken; with ``keep_rows`` also the document, as struct ``keep``."""
    md5 = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc).cast("string"), F.lit("null"))).cast("binary"))
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("keep")] if keep_rows else []
    sized = docs.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")).alias("name"), words_of(F.col(text)).alias("size"), md5.alias("order"), *kept).withColumn("bits", F.length(F.bin("size")))

    narrow = stored(sized.drop("keep"), "mix-sizes")  # a few numbers a document: the texts are read once for these
    if not keep_rows:
        sized = narrow

    totals = narrow.groupBy("source", "bits").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goals = targets(totals.groupBy("source").agg(F.sum("source_size").alias("source_size")), share=share, most=most, weights=weights)
    asked = totals.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("m"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()
    ranges = max(1, -(-asked["m"] // min(cell_rows, max(256, asked["n"] // SHARES))))

    cell = F.floor(_rank_value(F.col("order")) * F.lit(ranges) / F.lit(1 << 32)).cast("int")
    celled = sized.withColumn("cell", cell)
    cells = narrow.withColumn("cell", cell).groupBy("name", "bits", "cell").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("rows"))
    in_order = Window.partitionBy("name").orderBy("bits", "cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        cells.withColumn("before", F.coalesce(F.sum("rows").over(in_order), F.lit(0)))
        .alias("c")
        .join(goals.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")))
        .select("c.name", "c.bits", "c.cell", "before", "g.source_size", "target")
    )
    # ranks and the join are dealt by the same columns: documents are shuffled once
    within = Window.partitionBy("name", "bits", "cell").orderBy("order", "doc_id", "size")
    placed = celled.withColumn("rank", F.row_number().over(within)).join(plan, ["name", "bits", "cell"])

    offset = _rank_value(F.md5(F.concat(F.lit(seed + "/"), F.coalesce(F.col("source").cast("string"), F.lit("null"))).cast("binary"))) / F.lit(float(1 << 32))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("before") + F.col("rank")
    copies = (F.floor(offset + place * each) - F.floor(offset + (place - F.lit(1)) * each)).cast("long")
    return placed.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *(["keep"] if keep_rows else []))


def op7(docs: DataFrame) -> DataFrame:
    return mixed(docs).drop("copies")


def mixture(docs: DataFrame) -> DataFrame:
    """The documents of the mix with the columns they came with, each as often as it is taken."""
    taken = mixed(docs, keep_rows=True).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("keep.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS n, 2e0 * source_size AS cap FROM s),
w AS (SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS w FROM r),
l AS (
  SELECT *, (1.5e0 * (SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER b, 0)) / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0)) AS lev
  FROM w WINDOW b AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, (SELECT max(lev) FROM l) * w) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS e,
         CAST('0x' || substr(md5('mix-1/' || coalesce(d.source, 'null')), 1, 8) AS BIGINT)::DOUBLE / 4294967296e0 AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY length(bin(d.size)), o, d.doc_id, d.size) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST((floor(u + k * e) - floor(u + (k - 1) * e)) * size AS BIGINT) AS taken FROM p
"""

"""Chat formatting: cumulative snapshots of a conversation are collapsed to the longest, which are rendered.

A turn's hash is the MD5 of role and text. The hash of a prefix is the sum, over its turns, of the MD5 of (place, turn's
hash), in four lanes of 32 bits: a rolling sum, so equal prefixes of different conversations have equal hashes. A
conversation whose whole hash is a proper prefix of another one is dropped by an anti-join on (length, hash); of
conversations that are equal throughout, the least conv_id stands for all and ``n_logged`` counts them. What stays is
rendered, turn by turn, in parts of ``part_turns`` turns.

Only DataFrame functions. A conversation is cut into blocks of turn numbers, so that neither ranks nor sums of a very
long one are made in one task: windows run within (conversation, block), and the blocks' counts and sums, one row each,
give the offsets. Prefixes that very many conversations share are made distinct by an aggregate before they meet.

Defined results: a row repeated as a whole counts once; turns of equal number are ordered by their hash; a null turn
comes first; a null role is rendered as ``unknown``, a null text as empty, yet neither equals the other; rows of null
conv_id form one conversation, which stands for equal ones only if there is no other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.llm._shared import stored

LANES = ("h1", "h2", "h3", "h4")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _turn_hash(role: Column, text: Column) -> Column:
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.md5(F.concat(mark(role), F.lit("\x1f"), mark(text)).cast("binary"))


def _lane(hexes: Column, k: int) -> Column:
    return F.conv(F.substring(hexes, 1 + 8 * k, 8), 16, 10).cast("long")


def rolled(turns: DataFrame, block_turns: int = 1024) -> DataFrame:
    """conv, turn, hash, pos, n and the lanes of the prefix that ends there, of distinct (conv, turn, hash)."""
    cut = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 62))))
    same = lambda a, b: F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv")) & (F.col(f"{a}.block") == F.col(f"{b}.block"))
    within = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "hash")
    blocks = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    counts = cut.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.withColumn("before", F.coalesce(F.sum("c").over(blocks), F.lit(0))).withColumn("n", F.sum("c").over(Window.partitionBy("conv"))).drop("c")
    placed = cut.withColumn("rank", F.row_number().over(within)).alias("t").join(counts.alias("c"), same("t", "c")).select("t.conv", "t.block", "turn", "hash", (F.col("before") + F.col("rank")).cast("long").alias("pos"), F.col("n").cast("long").alias("n"))
    hashed = placed.withColumn("x", F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), "hash").cast("binary"))).select("*", *[_lane(F.col("x"), k).alias(h) for k, h in enumerate(LANES)]).drop("x")

    sums = hashed.groupBy("conv", "block").agg(*[F.sum(h).alias(h) for h in LANES])
    sums = sums.select("conv", "block", *[F.coalesce(F.sum(h).over(blocks), F.lit(0)).alias(f"o_{h}") for h in LANES])
    rolling = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.select("conv", "block", "turn", "hash", "pos", "n", *[F.sum(h).over(rolling).alias(h) for h in LANES])
    return summed.alias("t").join(sums.alias("s"), same("t", "s")).select("t.conv", "turn", "hash", "pos", "n", *[(F.col(h) + F.col(f"o_{h}")).alias(h) for h in LANES])


def formatted(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = 512) -> DataFrame:
    """conv_id, part, n_turns, n_logged, text: the rendered maximal conversations."""
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")).withColumn("hash", _turn_hash(F.col("role"), F.col("text")))
    prefixes = stored(rolled(rows.select("conv", "turn", "hash").distinct()), "chat-prefixes")
    whole = prefixes.filter("pos = n").groupBy("n", *LANES).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_logged"))
    inner = prefixes.filter("pos < n").select(F.col("pos").alias("n"), *LANES).distinct()
    stay = whole.join(inner, ["n", *LANES], "left_anti").select(F.col("conv").alias("s_conv"), "n_logged")
    places = prefixes.join(stay, F.col("conv").eqNullSafe(F.col("s_conv"))).select(F.col("conv").alias("p_conv"), F.col("turn").alias("p_turn"), F.col("hash").alias("p_hash"), "pos", "n", "n_logged")
    met = rows.join(places, F.col("conv").eqNullSafe(F.col("p_conv")) & F.col("turn").eqNullSafe(F.col("p_turn")) & (F.col("hash") == F.col("p_hash")))
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    parts = met.withColumn("part", F.floor((F.col("pos") - 1) / part_turns).cast("long")).groupBy("conv", "part").agg(F.max("n").alias("n_turns"), F.max("n_logged").alias("n_logged"), F.array_sort(F.collect_set(F.struct("pos", line.alias("line")))).alias("lines"))
    return parts.select(F.col("conv").alias("conv_id"), "part", "n_turns", "n_logged", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))


def op1(conversations: DataFrame) -> DataFrame:
    return formatted(conversations)


ORACLE_SQL = r"""
WITH b AS (
  SELECT DISTINCT conv_id, turn, role, text,
         md5(coalesce('=' || role, '-') || chr(31) || coalesce('=' || text, '-')) AS h
  FROM conversations),
p AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
         md5(CAST(list(h) OVER w AS VARCHAR)) AS prefix
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT n, prefix, min(conv_id) AS conv_id, count(*) AS n_logged FROM p WHERE pos = n GROUP BY n, prefix),
s AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = f.n AND p.prefix = f.prefix))
SELECT p.conv_id, CAST((p.pos - 1) // 512 AS BIGINT) AS part, CAST(max(p.n) AS BIGINT) AS n_turns, CAST(max(s.n_logged) AS BIGINT) AS n_logged,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY p.pos) AS text
FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
GROUP BY p.conv_id, (p.pos - 1) // 512
"""

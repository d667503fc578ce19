"""Statistics that the quality reports need: ranks, terciles, modes, concentration, crosswalks, quantile filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.sources.shared import stored


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Ranks with ties at their mean. Distinct values are ranged into partitions and counted; the partitions' sums, a row each,
    give the offsets, and counts are added up within partitions, so no task holds all values."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    ranged = stored(counts.repartitionByRange(value).withColumn("_p", F.spark_partition_id()), "ranks")
    ahead = lambda w: F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranged.groupBy("_p").agg(F.sum("_c").alias("_c")).select("_p", ahead(Window.orderBy("_p")).alias("_before"))
    ranks = ranged.withColumn("_own", ahead(Window.partitionBy("_p").orderBy(value))).join(offsets, "_p")
    return df.join(ranks.select(value, (F.col("_before") + F.col("_own") + (F.col("_c") + 1) / 2).alias(name)), value)


def ordered_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Ranks from 1 in a total order, in the same two levels."""
    ranged = stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranks")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order))).join(offsets, "_p").withColumn(name, F.col("_before") + F.col("_r")).drop("_p", "_r", "_before")


def strata(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, stratum) by thirds of the rank of a value over all rows, ties by key."""
    ranked = ordered_rank(df.select(key, F.coalesce(value, F.lit(0.0)).alias(value)), [value, key], "_rank")
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    return ranked.crossJoin(F.broadcast(n)).select(key, tercile(F.col("_rank"), F.col("_n")).alias("stratum"))  # one row is broadcast


def recall(bench: DataFrame, key: str, hits: dict[int, str]) -> DataFrame:
    """(stratum, n, recall_<radius> for each): shares of benchmark points with another within each radius, by stratum and over
    all rows (stratum ALL), from boolean columns."""
    shares = [F.avg(F.col(c).cast("double")).alias(f"recall_{r}") for r, c in hits.items()]
    return bench.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *shares).unionByName(bench.agg(F.lit("ALL").alias("stratum"), F.count(F.lit(1)).alias("n"), *shares))


def bias(recalls: DataFrame, radius: int) -> DataFrame:
    """One row: recall of the high stratum over that of the low one; null if that is 0."""
    of = lambda s: F.max(F.when(F.col("stratum") == s, F.col(f"recall_{radius}")))
    return recalls.agg(F.when(of("low") > 0, of("high") / of("low")).alias("ratio"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of complete pairs, as one row (rho, n)."""
    whole = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    return average_rank(average_rank(whole, x, "_rx"), y, "_ry").agg(F.corr("_rx", "_ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def tercile(rank: Column, n: Column) -> Column:
    """Third of a rank that starts at 1 and has no ties: the first third takes the remainder first."""
    return F.when(3 * (rank - 1) < n - 1, "low").when(3 * (rank - 1) < 2 * (n - 1), "mid").otherwise("high")


def mode(df: DataFrame, by: str, label: str) -> DataFrame:
    """Most frequent label of each group, the least on a tie, with its count and share."""
    pairs = df.filter(F.col(by).isNotNull() & F.col(label).isNotNull()).groupBy(by, label).agg(F.count(F.lit(1)).alias("c"))
    return pairs.groupBy(by).agg(F.min_by(label, F.struct(-F.col("c"), label)).alias(label), F.max("c").alias("n_mode"), F.sum("c").alias("n"))


def crosswalk(df: DataFrame, by: str, label: str, *, least: int, purity: float) -> DataFrame:
    """Which label a code stands for, if enough rows agree: OK, AMBIGUOUS, or too few."""
    m = mode(df, by, label).withColumn("purity", F.col("n_mode") / F.col("n"))
    status = F.when(F.col("n") < least, "TOO_FEW").when(F.col("purity") >= purity, "OK").otherwise("AMBIGUOUS")
    return m.withColumn("status", status).withColumn(label, F.when(F.col("status") == "OK", F.col(label)))


def concentration(df: DataFrame, by: str, value: str, *, lat: str, lng: str) -> DataFrame:
    """Of each cell: count, sum, largest, effective number, share of the three largest, weighted centre."""
    x = F.col(value)
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(x.desc())))
    return ranked.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_px"),
        F.sum(x).alias("total"),
        F.max(x).alias("largest"),
        (F.sum(x) * F.sum(x) / F.sum(x * x)).alias("n_eff"),
        (F.sum(F.when(F.col("_r") <= 3, x)) / F.sum(x)).alias("top3_share"),
        (F.sum(x * F.col(lat)) / F.sum(x)).alias("lat"),
        (F.sum(x * F.col(lng)) / F.sum(x)).alias("lng"),
    )


def above_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """Rows at or over the exact quantile, by linear interpolation."""
    limit = df.agg(F.percentile(value, q).alias("_limit"))
    return df.crossJoin(F.broadcast(limit)).filter(F.col(value) >= F.col("_limit")).drop("_limit")  # one row is broadcast


def ratio_stats(df: DataFrame, a: str, b: str) -> DataFrame:
    r = F.try_divide(F.col(a), F.col(b))
    return df.agg(F.min(r).alias("r_min"), F.max(r).alias("r_max"), F.avg(r).alias("r_mean"), F.stddev_pop(r).alias("r_std"))

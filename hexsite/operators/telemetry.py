"""Station telemetry: merging runs, profiles of series, quality flags, differences between runs, payload parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.config import DEFAULT


def merge_runs(runs: DataFrame, *, key=("station", "hour"), rank="run", seq="seq", value="cars") -> DataFrame:
    """One value for each key: of the latest run, and in it the latest reading. Aggregated before the shuffle."""
    return runs.groupBy(*key).agg(F.max_by(value, F.struct(rank, seq)).alias(value), F.max(F.struct(rank, seq)).alias("_last")).withColumn(rank, F.col(f"_last.{rank}")).drop("_last")


def profile(series: DataFrame, *, key="station", at="hour", value="cars", seq="seq") -> DataFrame:
    """Of each series: readings, span, range, missing, negative and non-numeric values, repeated times, order of arrival.

    Values may be text; what isn't a number counts as such and is left out of the range."""
    number = F.col(value).try_cast("double") if dict(series.dtypes)[value] == "string" else F.col(value)
    previous = F.lag(at).over(Window.partitionBy(key).orderBy(seq))
    return (
        series.withColumn("_back", F.col(at) < previous)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(at).alias("t_min"),
            F.max(at).alias("t_max"),
            F.min(number).alias("v_min"),
            F.max(number).alias("v_max"),
            F.count_if(F.col(value).isNull()).alias("n_null"),
            F.count_if(number < 0).alias("n_negative"),
            F.count_if(F.col(value).isNotNull() & number.isNull()).alias("n_nonnum"),
            (F.count(at) - F.count_distinct(at)).alias("n_repeated"),
            (F.count_if("_back") == 0).alias("monotonic"),
        )
    )


def quality_flag(sparse: int = DEFAULT.sparse_points, coord_ok: Column | None = None) -> Column:
    """Flags of a profile, joined by ``;``; a series without readings has no others than NO_TS."""
    bad = F.when(~coord_ok, "COORD_INVALID") if coord_ok is not None else F.lit(None).cast("string")
    rest = [
        F.when(F.col("n_repeated") > 0, "DUP_TS"),
        F.when(~F.col("monotonic"), "NONMONOTONIC"),
        F.when(F.col("n_negative") > 0, "NEG_VALUE"),
        F.when(F.col("n_nonnum") > 0, "NONNUMERIC"),
        F.when(F.col("v_max") == 0, "ALL_ZERO"),
        F.when(F.col("n") < sparse, "SPARSE"),
    ]
    return F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, F.concat_ws(";", bad, F.lit("NO_TS"))).otherwise(F.concat_ws(";", bad, *rest))


def compare_runs(a: DataFrame, b: DataFrame, *, key="station", at="hour", value="cars") -> DataFrame:
    """Verdict of each station over the time both runs cover; values are compared as text."""
    span = lambda df, p: df.groupBy(key).agg(F.min(at).alias(f"{p}_min"), F.max(at).alias(f"{p}_max"), F.count(F.lit(1)).alias(f"{p}_n"))
    spans = span(a, "a").join(span(b, "b"), key, "full")
    window = spans.withColumn("lo", F.when(F.col("a_min").isNotNull() & F.col("b_min").isNotNull(), F.greatest("a_min", "b_min"))).withColumn("hi", F.when(F.col("a_min").isNotNull() & F.col("b_min").isNotNull(), F.least("a_max", "b_max")))
    text = lambda df, p: df.select(key, at, F.col(value).cast("string").alias(p))
    both = text(a, "va").withColumn("ina", F.lit(True)).join(text(b, "vb").withColumn("inb", F.lit(True)), [key, at], "full")
    inside = both.join(window.select(key, "lo", "hi"), key).filter(F.col(at).between(F.col("lo"), F.col("hi")))
    counts = inside.groupBy(key).agg(
        F.count_if(F.col("ina") & F.col("inb")).alias("n_common"),
        F.count_if(F.col("ina") & F.col("inb") & ~F.col("va").eqNullSafe(F.col("vb"))).alias("n_mismatch"),
        F.count_if(F.col("inb").isNull()).alias("n_only_a"),
        F.count_if(F.col("ina").isNull()).alias("n_only_b"),
    )
    out = window.join(counts, key, "left").fillna(0, ["n_common", "n_mismatch", "n_only_a", "n_only_b"])
    verdict = (
        F.when(F.col("a_n").isNull(), "NEW_STATION")
        .when(F.col("b_n").isNull(), "EMPTY_SIDE")
        .when(F.col("lo") > F.col("hi"), "NO_OVERLAP")
        .when(F.col("n_mismatch") > 0, "VALUE_MISMATCH")
        .when((F.col("n_only_a") > 0) | (F.col("n_only_b") > 0), "TS_SET_DIFF")
        .otherwise("IDENTICAL")
    )
    return out.select(key, verdict.alias("verdict"), "n_common", "n_mismatch", "n_only_a", "n_only_b")


def parse_history(payload: str) -> Column:
    """struct(points, n_bad) of a JSON text of ``[[ts, v], ...]`` or ``[{timestamp, value}, ...]``; null if it is no list."""
    pairs = F.from_json(payload, "array<string>")
    one = lambda x: F.struct(
        F.coalesce(F.get_json_object(x, "$.timestamp"), F.get_json_object(x, "$[0]")).try_cast("bigint").alias("ts"),
        F.coalesce(F.get_json_object(x, "$.value"), F.get_json_object(x, "$[1]")).alias("value"),
    )
    points = F.transform(pairs, one)
    good = F.filter(points, lambda p: p["ts"].isNotNull())
    return F.when(pairs.isNotNull(), F.struct(good.alias("points"), (F.size(points) - F.size(good)).alias("n_bad")))


def time_weighted_mean(series: DataFrame, *, key="station", at="hour", value="cars") -> DataFrame:
    """Trapezoid mean over irregular times; a series of one time has its plain mean."""
    w = Window.partitionBy(key).orderBy(at)
    one = series.groupBy(key, at).agg(F.avg(value).alias("v"))
    step = one.withColumn("dt", F.lead(at).over(w) - F.col(at)).withColumn("mid", (F.lead("v").over(w) + F.col("v")) / 2)
    return step.groupBy(key).agg(F.coalesce(F.try_divide(F.sum(F.col("mid") * F.col("dt")), F.sum("dt")), F.avg("v")).alias("mean"))

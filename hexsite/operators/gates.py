"""Quality gates as data: conditions over a table become rows (gate, status, value, limit, detail), in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """``value`` is an aggregate; it must not be over (``most``) or under (``least``) a limit. ``warn``: only says so."""

    name: str
    value: Column
    most: float | None = None
    least: float | None = None
    warn: bool = False


def none_where(name: str, bad: Column, **how) -> Gate:
    """No row may meet the condition; null isn't met."""
    return Gate(name, F.count_if(F.coalesce(bad, F.lit(False))).cast("double"), most=0.0, **how)


def unique(name: str, *keys: str) -> Gate:
    return Gate(name, (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).cast("double"), most=0.0)


def share_of(name: str, good: Column, least: float, **how) -> Gate:
    """At least this share of rows; of an empty table the share is 1."""
    return Gate(name, F.coalesce(F.avg(F.coalesce(good, F.lit(False)).cast("double")), F.lit(1.0)), least=least, **how)


def evaluate(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """One aggregate over the table, a row for each gate. A value that is null fails."""
    one = df.agg(*[g.value.cast("double").alias(g.name) for g in gates])
    rows = F.array(
        *[
            F.struct(F.lit(g.name).alias("gate"), F.lit(g.warn).alias("warn"), F.col(g.name).alias("value"), F.lit(g.most).cast("double").alias("most"), F.lit(g.least).cast("double").alias("least"))
            for g in gates
        ]
    )
    out = one.select(F.explode(rows).alias("g")).select("g.*")
    good = F.col("value").isNotNull() & (F.col("most").isNull() | (F.col("value") <= F.col("most"))) & (F.col("least").isNull() | (F.col("value") >= F.col("least")))
    return out.select("gate", F.when(good, "PASS").when(F.col("warn"), "WARN").otherwise("FAIL").alias("status"), "value", F.coalesce("most", "least").alias("limit"))


class GateFailed(RuntimeError):
    pass


def enforce(report: DataFrame) -> list:
    """The report's rows, of bounded number; GateFailed if one fails."""
    return passed(report.collect())


def passed(rows: list) -> list:
    """Rows of a report that was read already; GateFailed if one fails."""
    if bad := [r["gate"] for r in rows if r["status"] == "FAIL"]:
        raise GateFailed(", ".join(bad))
    return rows


def orphans(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Child keys without a parent."""
    return child.select(on).distinct().join(parent.select(on), on, "left_anti")


def is_subset(name: str, part: DataFrame, whole: DataFrame, on: str) -> DataFrame:
    """One row: how many keys of one table another lacks; none may."""
    return orphans(part, whole, on).agg(F.lit(name).alias("gate"), F.when(F.count(F.lit(1)) == 0, "PASS").otherwise("FAIL").alias("status"), F.count(F.lit(1)).cast("double").alias("value"), F.lit(0.0).alias("limit"))


def are_disjoint(name: str, a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """One row: how many keys two tables share; none may."""
    both = a.select(on).distinct().join(b.select(on), on, "left_semi")
    return both.agg(F.lit(name).alias("gate"), F.when(F.count(F.lit(1)) == 0, "PASS").otherwise("FAIL").alias("status"), F.count(F.lit(1)).cast("double").alias("value"), F.lit(0.0).alias("limit"))


def reconciles(name: str, total: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row: the parts' rows add up to the total's."""
    one = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    out = one(total, "n")
    for i, p in enumerate(parts):
        out = out.crossJoin(one(p, f"p{i}"))  # rows of one
    summed = sum((F.col(f"p{i}") for i in range(len(parts))), F.lit(0))
    return out.select(F.lit(name).alias("gate"), F.when(summed == F.col("n"), "PASS").otherwise("FAIL").alias("status"), (F.col("n") - summed).cast("double").alias("value"), F.lit(0.0).alias("limit"))

"""Electricity tariff: prices by voltage group and time band, blended prices, bands of clock times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The average price, percentages by group and band, and clock hours of a week.
AVERAGE = 2204.07
PERCENT = {("tren_1kv", "binh_thuong"): 118.0, ("tren_1kv", "thap_diem"): 71.0, ("tren_1kv", "cao_diem"): 174.0, ("den_1kv", "binh_thuong"): 125.0, ("den_1kv", "thap_diem"): 75.0, ("den_1kv", "cao_diem"): 195.0}
HOURS = {"binh_thuong": 96.0, "thap_diem": 42.0, "cao_diem": 30.0}


def matrix(spark: SparkSession, average: float = AVERAGE) -> DataFrame:
    rows = spark.createDataFrame([(g, b, p) for (g, b), p in PERCENT.items()], "voltage_group string, band string, percent double")
    return rows.withColumn("price", F.bround(F.lit(average) * F.col("percent") / 100, 2))


def price(df: DataFrame, group: str, band: str, tariff: DataFrame) -> DataFrame:
    """Joins the price; an unknown pair is an error, not a null."""
    out = df.join(F.broadcast(tariff.select(F.col("voltage_group").alias("_g"), F.col("band").alias("_b"), "price")), (F.col(group) == F.col("_g")) & (F.col(band) == F.col("_b")), "left")  # six rows
    known = F.when(F.col("price").isNull(), F.raise_error(F.concat(F.lit("no tariff for "), F.coalesce(group, F.lit("null")), F.lit("/"), F.coalesce(band, F.lit("null")))).cast("double")).otherwise(F.col("price"))
    return out.withColumn("price", known).drop("_g", "_b")


def blended(tariff: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Price of each group under shares of the bands, which must sum to 1."""
    if abs(sum(shares.values()) - 1) > 1e-6:
        raise ValueError("the shares don't sum to 1")
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("band")), F.lit(0.0))
    return tariff.groupBy("voltage_group").agg(F.bround(F.sum(F.col("price") * weight), 2).alias("blended"))


def clock_shares() -> dict[str, float]:
    return {k: v / sum(HOURS.values()) for k, v in HOURS.items()}


def band_of(at: Column) -> Column:
    """Band of a timestamp: peak 9:30-11:30 and 17-20 except on Sundays, off-peak 22-4."""
    minute = F.hour(at) * 60 + F.minute(at)
    peak = ((minute >= 570) & (minute < 690)) | ((minute >= 1020) & (minute < 1200))
    return F.when(peak & (F.dayofweek(at) != 1), "cao_diem").when((minute >= 1320) | (minute < 240), "thap_diem").otherwise("binh_thuong")

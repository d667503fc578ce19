"""Coordinates of stations: stacked points, rows far from their province, and the repair tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.functions.columns import truth
from hexsite.functions.geo import coordinates_valid, haversine_sql
from hexsite.operators.spatial import nearest_of_few


def stacks(df: DataFrame, physical: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """``stack``: how many physical stations stand on the same point, to six decimals."""
    point = [F.round(lat, 6).alias("_la"), F.round(lng, 6).alias("_lo")]
    sizes = df.groupBy(*point).agg(F.count_distinct(physical).alias("stack"))
    return df.withColumns({"_la": F.round(lat, 6), "_lo": F.round(lng, 6)}).join(sizes, ["_la", "_lo"], "left").drop("_la", "_lo")


def mismatch(df: DataFrame, centroids: DataFrame, *, key="site_id", province="province", far_km=100.0, margin_km=75.0) -> DataFrame:
    """own_km, far, mismatch: far from the own province's centroid, another is nearest, by a margin."""
    near = nearest_of_few(df, key, centroids, province).select(key, F.col("nearest").alias("near"), (F.col("dist_m") / 1000).alias("near_km"))
    own = centroids.select(F.col(province).alias("_p"), F.col("lat").alias("_la"), F.col("lng").alias("_lo"))
    out = df.join(own, F.col(province) == F.col("_p"), "left").withColumn("own_km", F.expr(haversine_sql("lat", "lng", "_la", "_lo")) / 1000).drop("_p", "_la", "_lo").join(near, key, "left")
    far = truth(F.col("own_km") > far_km)
    return out.withColumn("far", far).withColumn("mismatch", truth(far & (F.col("near") != F.col(province)) & (F.col("own_km") - F.col("near_km") > margin_km)))


def repair(df: DataFrame, *, stack_min: int = 5, snap_km: float = 100.0, moved_km: float = 0.05) -> DataFrame:
    """Trust the point, snap to a good registry point, or leave it unresolved without a cell; raw values stay.

    Reads lat, lng, far, stack, suspect, off_lat, off_lng, off_own_km, off_stack. A point that isn't a placeholder is kept,
    but it is resolved, and has a cell, only if its coordinates are valid; so does a point to snap to count.
    """
    valid, off_valid = coordinates_valid("lat", "lng"), coordinates_valid("off_lat", "off_lng")
    bad = truth((F.col("stack") >= stack_min) & F.col("far")) | truth(F.col("suspect") & (F.col("stack") >= 2) & F.col("far"))
    moved = F.expr(haversine_sql("lat", "lng", "off_lat", "off_lng")) / 1000
    good = off_valid & valid & truth((F.col("off_own_km") <= snap_km) & (F.col("off_stack") < stack_min) & (moved > moved_km))
    fix = F.when(~bad & valid, "TRUSTED").when(~bad, "INVALID").when(good, "SNAPPED").otherwise("UNRESOLVED")
    out = df.withColumn("placeholder", bad).withColumn("fix", fix)
    out = out.withColumnsRenamed({"lat": "lat_raw", "lng": "lng_raw"})
    for c in ("lat", "lng"):
        out = out.withColumn(c, F.when(F.col("fix") == "TRUSTED", F.col(f"{c}_raw")).when(F.col("fix") == "SNAPPED", F.col(f"off_{c}")))
    return out.withColumn("coord_resolved", F.col("fix").isin("TRUSTED", "SNAPPED")).withColumn("cell", grid.cell_of("lat", "lng"))

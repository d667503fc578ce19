"""Spatial joins: within a radius, nearest, coverage, points in polygons, hexagons over polygons.

A join within a radius is an equality join: the right side is put in every cell of a lattice around its own, the left
side in its own, and the distance is tested where cells meet. In each band of latitude the columns are wider than the radius
there, so no pair is missed and none is found twice. Nothing is broadcast, whatever the sizes are taken for (joins with rows
of the tables say so by a hint), and no row meets all others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.functions.geo import haversine_m, haversine_sql
from hexsite.sources.shared import stored

DEGREE_M = 111_320.0


def _columns(band: Column, step: float) -> Column:
    """Width in degrees of a lattice column in a band of latitude: over the radius in this band and those beside it."""
    top = F.least(F.greatest(F.abs(band), F.abs(band + 1)).cast("double") * step + 2 * step, F.lit(89.9))
    return F.least(F.lit(step * 1.02) / F.cos(F.radians(top)), F.lit(120.0))


def within(left: DataFrame, right: DataFrame, radius_m: float, *, lat: str = "lat", lng: str = "lng", alike: tuple[str, ...] = ()) -> DataFrame:
    """Pairs no farther apart than the radius, with ``dist_m``. Columns of left keep their names, right's get ``r_``.

    ``alike``: columns of both sides that must be equal, and not null; they are keys of the join, so other rows never meet.
    At any latitude up to 85 degrees, and across the meridian of 180 degrees; for radii up to some 500 km. Rows without
    coordinates meet nobody.
    """
    step = radius_m / DEGREE_M * 1.01
    band = lambda c: F.floor(F.col(c) / step).cast("long")
    at = lambda lng: F.floor(lng / F.col("_w")).cast("long")
    a = left.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).withColumn("_x", band(lat))
    a = a.withColumn("_w", _columns(F.col("_x"), step)).withColumn("_y", at(F.col(lng))).drop("_w")
    b = right.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    b = b.withColumn("_b", band(f"r_{lat}")).withColumn("_x", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1))).withColumn("_w", _columns(F.col("_x"), step))
    # the column of the point, and that of the same meridian counted once round the globe, where that is near
    there = F.col(f"r_{lng}")
    turned = F.when(there < 2 * F.col("_w") - 180, there + 360).when(there > 180 - 2 * F.col("_w"), there - 360)
    b = b.withColumn("_c", F.explode(F.array_compact(F.array(at(there), at(turned)))))
    b = b.withColumn("_y", F.explode(F.array(F.col("_c") - 1, F.col("_c"), F.col("_c") + 1))).drop("_b", "_w", "_c")
    # the estimate of an exploded side leaves out that it is exploded: without the hint a small file is broadcast, nine times over
    same = [f"_a{i}" for i in range(len(alike))]
    a, b = a.withColumns(dict(zip(same, map(F.col, alike), strict=True))), b.withColumns({k: F.col(f"r_{c}") for k, c in zip(same, alike, strict=True)})
    met = a.join(b.hint("merge"), ["_x", "_y", *same]).drop("_x", "_y", *same).withColumn("dist_m", haversine_m(lat, lng, f"r_{lat}", f"r_{lng}"))
    return met.filter(F.col("dist_m") <= radius_m)


def self_pairs(df: DataFrame, key: str, radius_m: float, **how) -> DataFrame:
    """Unordered pairs of different rows within the radius: key < r_key."""
    return within(df, df, radius_m, **how).filter(F.col(key) < F.col(f"r_{key}"))


def exists_within(points: DataFrame, key: str, other: DataFrame, radii_m: list[float], **how) -> DataFrame:
    """For each point and radius, whether another point is that near: one join at the largest radius."""
    near = within(points, other, max(radii_m), **how).groupBy(key).agg(F.min("dist_m").alias("nearest_m"))
    out = points.join(near.hint("merge"), key, "left")
    return out.select(key, *[F.coalesce(F.col("nearest_m") <= r, F.lit(False)).alias(f"within_{int(r)}") for r in radii_m])


def crowded_radius(right: DataFrame, radius_m: float, *, enough: float = 8.0, lat: str = "lat", lng: str = "lng") -> float:
    """A radius, at most the given one, in which a row of right has about ``enough`` others, as a mean over the rows."""
    step = radius_m / DEGREE_M
    x = F.floor(F.col(lat) / step)
    cells = right.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).groupBy(x.alias("x"), F.floor(F.col(lng) * F.cos(F.radians(x * step)) / step).alias("y")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    others = (cells.agg(F.sum(F.col("n") * (F.col("n") - 1)) / F.sum("n")).first()[0] or 0.0) * math.pi  # in a circle, from those in a square
    return radius_m * min(1.0, math.sqrt(enough / others)) if others else radius_m


def nearest(left: DataFrame, key: str, right: DataFrame, right_key: str, radii_m: list[float], **how) -> DataFrame:
    """Nearest right row of each left row, by growing radii: only what found nothing goes on to the next. Null beyond.

    Where right is crowded, rounds at smaller radii come before the first, so that no row meets hundreds of others.
    Each round is stored, so no radius computes the smaller ones again, and the rounds end when nothing is left.
    """
    rest, right = left.select(key, "lat", "lng"), right.select(right_key, "lat", "lng")
    found, before, r = None, [], crowded_radius(right, radii_m[0])
    while r < radii_m[0]:
        before.append(r)
        r *= 4
    for r in [*before, *radii_m]:
        best = within(rest, right, r, **how).groupBy(key).agg(F.min(F.struct("dist_m", F.col(f"r_{right_key}").alias("to"))).alias("b")).select(key, F.col("b.to").alias("nearest"), F.col("b.dist_m").alias("dist_m"))
        best = stored(best, "nearest")
        found = best if found is None else found.unionByName(best)
        rest = stored(rest.join(best.select(key).hint("merge"), key, "left_anti"), "nearest-rest")
        if not rest.count():  # of a stored table: its footers are read
            break
    return left.select(key).join(found.hint("merge"), key, "left")


def nearest_of_few(df: DataFrame, key: str, few: DataFrame, few_key: str, *, most: int = 5000) -> DataFrame:
    """Nearest of a small set, such as province centroids. The set is counted first; a larger one is refused."""
    few = few.select(F.col(few_key).alias("_k"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
    n = few.limit(most + 1).count()
    if n > most:
        raise ValueError(f"over {most} rows: use nearest()")
    pairs = df.select(key, "lat", "lng").join(F.broadcast(few)).withColumn("d", haversine_m("lat", "lng", "_lat", "_lng"))
    return pairs.groupBy(key).agg(F.min(F.struct("d", "_k")).alias("b")).select(key, F.col("b._k").alias("nearest"), F.col("b.d").alias("dist_m"))


def coverage(sites: DataFrame, key: str, cells: DataFrame, radius_km: float) -> DataFrame:
    """(key, cell): cells of the table whose centre is within the radius of a site."""
    steps = grid.steps(grid.rings_for(radius_km))
    own = sites.select(key, "lat", "lng", grid.cell_of("lat", "lng").alias("_own"))
    around = own.select(key, "lat", "lng", F.explode(F.transform(F.array(*map(F.lit, steps)), lambda s: F.col("_own") + s)).alias("cell"))
    near = around.filter(F.expr(haversine_sql("lat", "lng", *grid.centre_sql("cell"))) <= radius_km * 1000)
    return near.select(key, "cell").join(cells.select("cell"), "cell", "left_semi").select(key, "cell")


def all_boxes(points: DataFrame, key: str, boxes: DataFrame, name: str) -> DataFrame:
    """(key, name) of each box that holds a point, edges counting. Boxes are put in lattice cells first."""
    step = 0.25
    tiles = lambda lo, hi: F.sequence(F.floor(F.col(lo) / step).cast("long"), F.floor(F.col(hi) / step).cast("long"))
    b = boxes.withColumn("_x", F.explode(tiles("lat0", "lat1"))).withColumn("_y", F.explode(tiles("lng0", "lng1")))
    p = points.select(key, "lat", "lng").withColumn("_x", F.floor(F.col("lat") / step).cast("long")).withColumn("_y", F.floor(F.col("lng") / step).cast("long"))
    return p.join(b, ["_x", "_y"]).filter(F.col("lat").between(F.col("lat0"), F.col("lat1")) & F.col("lng").between(F.col("lng0"), F.col("lng1"))).select(key, name)


def in_boxes(points: DataFrame, key: str, boxes: DataFrame, name: str) -> DataFrame:
    """First box, by name, that holds each point (edges count); null if none does."""
    first = all_boxes(points, key, boxes, name).groupBy(key).agg(F.min(name).alias(name))
    return points.select(key).join(first, key, "left")


def zone_flags(cells: DataFrame, zones: DataFrame, flag: str = "flag") -> DataFrame:
    """(cell, flags): all flags, sorted, of the zones that hold a cell's centre (cell, lat, lng); cells in none are left out."""
    return all_boxes(cells, "cell", zones, flag).groupBy("cell").agg(F.array_sort(F.collect_set(flag)).alias("flags"))  # as many as there are kinds of zones


def nearest_box(points: DataFrame, key: str, boxes: DataFrame, name: str, most_m: float) -> DataFrame:
    """Box of a point, or of a miss the nearest within a tolerance: (key, name, method inside / nearest / none)."""
    inside = in_boxes(points, key, boxes, name)
    missed = points.join(inside.filter(F.col(name).isNull()).select(key), key, "left_semi")
    step, pad = 0.25, most_m / DEGREE_M
    tiles = lambda lo, hi: F.sequence(F.floor((F.col(lo) - pad) / step).cast("long"), F.floor((F.col(hi) + pad) / step).cast("long"))
    b = boxes.withColumn("_x", F.explode(tiles("lat0", "lat1"))).withColumn("_y", F.explode(tiles("lng0", "lng1")))
    p = missed.select(key, "lat", "lng").withColumn("_x", F.floor(F.col("lat") / step).cast("long")).withColumn("_y", F.floor(F.col("lng") / step).cast("long"))
    zero = F.lit(0.0)
    dy = F.greatest(F.col("lat0") - F.col("lat"), F.col("lat") - F.col("lat1"), zero)
    dx = F.greatest(F.col("lng0") - F.col("lng"), F.col("lng") - F.col("lng1"), zero)
    near = p.join(b, ["_x", "_y"]).withColumn("d", F.sqrt(dx * dx + dy * dy) * DEGREE_M).filter(F.col("d") <= most_m)
    best = near.groupBy(key).agg(F.min(F.struct("d", name)).alias("b")).select(F.col(key).alias("_k"), F.col(f"b.{name}").alias("_near"))
    out = inside.join(best, F.col(key) == F.col("_k"), "left")
    method = F.when(F.col(name).isNotNull(), "inside").when(F.col("_near").isNotNull(), "nearest").otherwise("none")
    return out.select(key, method.alias("method"), F.coalesce(name, "_near").alias(name))


def accept_first(pairs: DataFrame, key: str, good: Column, *order: str) -> DataFrame:
    """Of each key's candidates in order, the first that is good."""
    return pairs.filter(good).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_r = 1").drop("_r")


def outside_all(points: DataFrame, key: str, disks: DataFrame, radius: str, most_m: float, **how) -> DataFrame:
    """Points in no disk; each disk has a radius of its own, up to ``most_m``, and one of 0 holds nothing."""
    inside = within(points.select(key, "lat", "lng"), disks.filter(F.col(radius) > 0).select("lat", "lng", radius), most_m, **how)
    return points.join(inside.filter(F.col("dist_m") <= F.col(f"r_{radius}")).select(key), key, "left_anti")

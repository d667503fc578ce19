"""Roads and land cover on the grid: resampled segments, tiers, lanes, policy sums, class fractions, POI classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexsite.config import DEFAULT
from hexsite.functions import grid
from hexsite.functions.columns import lookup, number_in, truth
from hexsite.functions.geo import haversine_m

# Road classes of OpenStreetMap and their tiers.
TIERS = ["MOTORWAY", "TRUNK", "PRIMARY", "SECONDARY", "TERTIARY", "LOCAL", "SERVICE", "TRACK", "OTHER"]
TIER_OF = {
    "motorway": "MOTORWAY", "motorway_link": "MOTORWAY", "trunk": "TRUNK", "trunk_link": "TRUNK", "primary": "PRIMARY", "primary_link": "PRIMARY",
    "secondary": "SECONDARY", "secondary_link": "SECONDARY", "tertiary": "TERTIARY", "tertiary_link": "TERTIARY",
    "residential": "LOCAL", "unclassified": "LOCAL", "living_street": "LOCAL", "road": "LOCAL", "service": "SERVICE", "track": "TRACK",
}
NOT_DRIVABLE = ["footway", "path", "pedestrian", "steps", "cycleway", "bridleway", "corridor", "construction", "proposed", "raceway", "elevator", "platform"]
ONE_WAY = ["yes", "-1", "true", "1"]
STREET_PARKING = ["street_side", "lane", "on_kerb", "half_on_kerb", "shoulder"]
CLOSED = ["private", "no", "employees", "permit", "agricultural", "forestry", "delivery", "military"]
OPEN = ["yes", "public", "permissive", "customers", "destination"]


def tag(tags: Column, key: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.try_element_at(tags, F.lit(key)))), F.lit(""))


def tier_of(highway: Column) -> Column:
    """Tier of a road class; null for what can't be driven on, OTHER for what is unknown."""
    return F.when(highway.isin(NOT_DRIVABLE), None).otherwise(lookup(highway, TIER_OF, "OTHER"))


def lanes_of(tier: Column, lanes: Column, oneway: Column) -> tuple[Column, Column]:
    """(lanes, observed): the tag within 1 to 12, else 1 for service roads, tracks and one-way roads, else 2."""
    seen = number_in(lanes, 1, 12)
    guess = F.when(tier.isin("SERVICE", "TRACK") | truth(F.lower(F.trim(oneway)).isin(ONE_WAY)), 1.0).otherwise(2.0)
    return F.coalesce(seen, guess), seen.isNotNull()


def poi_class(category: Column, tags: Column) -> Column:
    shop = tag(tags, "shop")
    retail = F.when(shop == "supermarket", "SUPERMARKET").when(tag(tags, "amenity") == "marketplace", "MARKET").when(shop != "", "SUPERMARKET").otherwise("MARKET")
    return (
        F.when(category == "fuel", "FUEL")
        .when(category == "parking", F.when(tag(tags, "parking").isin(STREET_PARKING), "PARKING_STREET").otherwise("PARKING_OFF"))
        .when(category == "mall", F.when(shop == "mall", "MALL").otherwise("DEPT_STORE"))
        .when(category == "retail", retail)
        .when(category == "apartments", "APARTMENT")
    )


def poi_access(tags: Column) -> Column:
    """Three states; what isn't said is UNKNOWN and isn't dropped."""
    v = tag(tags, "access")
    return F.when(v.isin(CLOSED), "RESTRICTED").when(v.isin(OPEN), "PUBLIC").otherwise("UNKNOWN")


def levels_of(levels: Column) -> Column:
    return number_in(levels, 1, 100)


def exclusion_tag(tags: Column) -> Column:
    return (
        F.when((tag(tags, "landuse") == "military") | (tag(tags, "military") != ""), "MILITARY")
        .when((tag(tags, "boundary") == "protected_area") | (tag(tags, "leisure") == "nature_reserve"), "PROTECTED")
        .when(tag(tags, "aeroway") != "", "AIRPORT")
        .when((tag(tags, "natural") == "water") | (tag(tags, "waterway") != ""), "WATER_OSM")
    )


def segments(nodes: DataFrame, way: str, order: list[str], *, step_m: float = DEFAULT.road_step_m) -> DataFrame:
    """(way, cell, metres): each stretch between nodes is cut in floor(length / step) equal parts, one at the least,
    and each part counts where its middle lies."""
    from pyspark.sql import Window

    w = Window.partitionBy(way).orderBy(*order)
    pairs = nodes.withColumn("_la", F.lead("lat").over(w)).withColumn("_lo", F.lead("lng").over(w)).filter("_la IS NOT NULL")
    long = pairs.withColumn("_m", haversine_m("lat", "lng", "_la", "_lo")).withColumn("_n", F.greatest(F.lit(1), F.floor(F.col("_m") / step_m).cast("int")))
    parts = long.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    t = (F.col("_k") + 0.5) / F.col("_n")
    mid = parts.select(way, (F.col("lat") + t * (F.col("_la") - F.col("lat"))).alias("lat"), (F.col("lng") + t * (F.col("_lo") - F.col("lng"))).alias("lng"), (F.col("_m") / F.col("_n")).alias("metres"))
    return mid.select(way, grid.cell_of("lat", "lng").alias("cell"), "metres")


def road_layers(parts: DataFrame) -> DataFrame:
    """Metres, lane metres and observed lane metres of each tier, and bridges, of each cell.

    Reads cell, metres, tier, lanes, observed, bridge."""
    m, lm = F.col("metres"), F.col("metres") * F.col("lanes")
    out = []
    for t in TIERS:
        is_ = F.col("tier") == t
        out += [F.sum(F.when(is_, m).otherwise(0.0)).alias(f"m_{t}"), F.sum(F.when(is_, lm).otherwise(0.0)).alias(f"lane_m_{t}"), F.sum(F.when(is_ & F.col("observed"), lm).otherwise(0.0)).alias(f"lane_obs_m_{t}")]
    return parts.groupBy("cell").agg(*out, F.sum(F.when(F.col("bridge"), m).otherwise(0.0)).alias("bridge_m"))


def road_policy(layers: DataFrame) -> DataFrame:
    """Scalars of the road layers; a layer that is missing counts as 0."""
    have = set(layers.columns)
    total = lambda names: sum((F.coalesce(n, F.lit(0.0)) for n in names if n in have), F.lit(0.0))
    return layers.select(
        "cell",
        total(f"m_{t}" for t in TIERS if t not in ("SERVICE", "TRACK")).alias("road_len_m"),
        total(f"m_{t}" for t in TIERS).alias("road_access_m"),
        total(["lane_m_MOTORWAY"]).alias("road_lane_mw_m"),
        total(["lane_m_TRUNK", "lane_m_PRIMARY"]).alias("road_lane_ar_m"),
        total(["bridge_m"]).alias("road_bridge_m"),
    )


def observed_share(layers: DataFrame, tiers: list[str] = ("MOTORWAY", "TRUNK", "PRIMARY")) -> DataFrame:
    total = sum((F.sum(f"lane_m_{t}") for t in tiers), F.lit(0.0))
    seen = sum((F.sum(f"lane_obs_m_{t}") for t in tiers), F.lit(0.0))
    return layers.agg(F.coalesce(F.try_divide(seen, total), F.lit(0.0)).alias("share"))


def cover_fractions(pixels: DataFrame, groups: list[str], by: str = "cell", group: str = "grp") -> DataFrame:
    """n_px and the fraction of each class; the classes are given, so no pass is needed to find them."""
    n = F.count(F.lit(1))
    return pixels.groupBy(by).agg(n.alias("n_px"), *[(F.count_if(F.col(group) == g) / n).alias(f"frac_{g}") for g in groups])

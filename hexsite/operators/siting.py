"""Feasibility of cells, candidate sites, coverage gates and greedy choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.config import DEFAULT, Thresholds
from hexsite.functions.columns import flags_of, truth
from hexsite.operators.demand import tiers_for

TIER_RANK = {"T0": 0, "T1": 1, "T2": 2, "T3": 3, "T4": 4}


def feasibility(cells: DataFrame, t: Thresholds = DEFAULT, *, zones: str | None = None) -> DataFrame:
    """buildable, exclusion_flags, penalty_flags and penalty of cells with land-use fractions, access and distance.

    ``zones``: a column of flags of the zones a cell lies in (military, protected, airports, water); any of them excludes it.
    """
    crop = truth(F.col("frac_crop") >= t.crop_min)
    low = truth(F.col("built") < t.built_low)
    road = F.coalesce("road_access", F.lit(0.0))
    informal = (road > 0) & truth(F.coalesce("road_len", F.lit(0.0)) <= 0)
    bridge = (road > 0) & ((road - F.coalesce("road_bridge", F.lit(0.0))) <= 0)
    needs = truth(F.col("access_tier").isin("ADJACENT", "NEAR"))
    hard = {
        "WATER": F.col("frac_water") >= t.water_max,
        "WETLAND": F.col("frac_water") + F.col("frac_wetland") >= t.water_wet_max,
        "NOT_BUILT_UP": F.col("built") < t.built_min,
        "ROAD_ACCESS_ISOLATED": F.col("access_tier") == "ISOLATED",
    }
    distance = F.when(F.col("substation_m").isNull(), 0.5).otherwise(0.5 * F.least(F.col("substation_m") / t.substation_m, F.lit(1.0)))
    score = lambda c, x: F.when(c, x).otherwise(0.0)
    raw = score(crop, 0.3) + score(low, 0.2) + score(needs, 0.2) + score(informal, 0.1) + score(bridge, 0.1) + distance
    soft = {"CROP": crop, "LOW_BUILTUP": low, "POP_NO_ROAD": (F.col("pop") > 0) & (road <= 0), "NO_SUBSTATION": F.col("substation_m").isNull(), "NEEDS_ACCESS_ROAD": needs, "ROAD_ACCESS_INFORMAL": informal, "ROAD_BRIDGE_ONLY": bridge}
    excluded = flags_of(hard)
    if zones:
        excluded = F.array_sort(F.array_union(excluded, F.coalesce(F.col(zones), F.array().cast("array<string>"))))
    out = cells.withColumn("exclusion_flags", excluded).withColumn("penalty_flags", flags_of(soft))
    return out.withColumn("buildable", F.size("exclusion_flags") == 0).withColumn("penalty", F.bround(F.greatest(F.least(raw, F.lit(1.0)), F.lit(0.0)), 3))


def assembled(cells: DataFrame, land: DataFrame, demand: DataFrame, roads: DataFrame, zones: DataFrame, distances: DataFrame) -> DataFrame:
    """What feasibility reads, for all cells of an area: land-use fractions and demand (missing: 0), flags of zones, distance.

    A cell that the demand lacks isn't isolated for that: its tier and roads come from the whole road table.
    """
    measures = [c for c in land.columns if c != "cell"]
    road_columns = ["road_access", "road_len", "road_bridge"]
    out = cells.select("cell").join(land, "cell", "left").join(demand.select("cell", "pop", "access_tier", *road_columns), "cell", "left")
    gap = out.filter(F.col("access_tier").isNull()).select("cell")
    looked = tiers_for(gap, roads).withColumnRenamed("access_tier", "_tier").join(roads.select("cell", *[F.col(c).alias(f"_{c}") for c in road_columns]), "cell", "left")
    out = out.join(looked, "cell", "left").withColumn("access_tier", F.coalesce("access_tier", "_tier"))
    out = out.withColumns({**{c: F.coalesce(F.col(c), F.col(f"_{c}"), F.lit(0.0)) for c in road_columns}, **{c: F.coalesce(c, F.lit(0.0)) for c in ("pop", *measures)}})
    return out.drop("_tier", *[f"_{c}" for c in road_columns]).join(zones.select("cell", F.col("flags").alias("zones")), "cell", "left").join(distances.select("cell", "substation_m"), "cell", "left")


#: tiers of points of interest as anchors
POI_TIER = {"PARKING_OFF": "T1", "FUEL": "T1", "MALL": "T2", "DEPT_STORE": "T2", "SUPERMARKET": "T2", "MARKET": "T2", "APARTMENT": "T2"}


def poi_anchors(poi: DataFrame, *, key: str = "poi") -> DataFrame:
    """Points of interest that can be anchors, with their tier: inside the country, of a class that has a tier, one object
    each (``is_primary``), no parking that is restricted, and of a complex's apartments only the first; one without a complex stays.

    Reads class, access, is_primary, in_country, complex.
    """
    tier = F.try_element_at(F.create_map(*[F.lit(x) for kv in POI_TIER.items() for x in kv]), F.col("class"))
    fit = poi.filter(truth("in_country") & truth("is_primary") & ~truth((F.col("class") == "PARKING_OFF") & (F.col("access") == "RESTRICTED"))).withColumn("tier", tier).filter("tier IS NOT NULL")
    apartment = truth(F.col("class") == "APARTMENT") & F.col("complex").isNotNull()
    first = fit.filter(apartment).groupBy(F.col("complex").alias("_c")).agg(F.min(key).alias("_first"))
    return fit.filter(~apartment).unionByName(fit.filter(apartment).join(first, (F.col("complex") == F.col("_c")) & (F.col(key) == F.col("_first"))).drop("_c", "_first"))


def corroborated_only(cells: DataFrame, flagged: str, arterial_m: str, trips: str) -> DataFrame:
    """Cells without those that are flagged and that neither a main road nor a point of interest confirms."""
    return cells.filter(~truth(flagged) | truth(F.col(arterial_m) > 0) | truth(F.col(trips) > 0))


def best_per_cell(anchors: DataFrame) -> DataFrame:
    """One anchor a cell: the lowest tier, then the least reference. An aggregate: cells hold many anchors."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in TIER_RANK.items() for x in kv]), F.col("tier"))
    rest = [c for c in anchors.columns if c not in ("cell", "tier", "ref")]
    return anchors.groupBy("cell").agg(F.min(F.struct(rank.alias("rank"), F.col("ref"), F.col("tier"), *rest)).alias("b")).select("cell", "b.tier", "b.ref", *[f"b.{c}" for c in rest])


def trip_score(mall, dept, supermarket, market, complexes) -> Column:
    return F.col(mall) + F.col(dept) + F.col(supermarket) + 0.5 * F.col(market) + F.col(complexes)


def gap_score(pop: Column, trips: Column, arterial_m: Column, motorway_m: Column) -> Column:
    return pop + 50 * trips + 0.025 * arterial_m + 0.05 * motorway_m


def capex_class(tier: Column, penalty: Column) -> Column:
    return F.when(tier == "T0", "low").when((tier == "T4") | (F.coalesce(penalty, F.lit(0.0)) >= 0.5), "high").otherwise("mid")


def numbered(df: DataFrame, order: list[str], prefix: str = "C", width: int = 6) -> DataFrame:
    """Sequential ids in a total order, from 0. Rows are ranged into partitions and stored; the partitions' counts, a row
    each, give the offsets, and ranks are made within partitions, so no task holds all rows."""
    from hexsite.sources.shared import stored

    ranged = stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order))).join(counts, "_p")
    return placed.withColumn("candidate_id", F.concat(F.lit(prefix), F.lpad((F.col("_before") + F.col("_r") - 1).cast("string"), width, "0"))).drop("_p", "_n", "_before", "_r")


def union_coverage(covered: DataFrame, cells: DataFrame, pop: str) -> DataFrame:
    """Population of cells covered by any site, and its share."""
    hit = cells.join(covered.select("cell").distinct(), "cell", "left_semi").agg(F.coalesce(F.sum(pop), F.lit(0.0)).alias("covered"))
    return hit.crossJoin(F.broadcast(cells.agg(F.sum(pop).alias("total")))).withColumn("share", F.col("covered") / F.col("total"))  # rows of one


def distinct_coverage(covered: DataFrame, key: str) -> DataFrame:
    """Share of candidates with a coverage set of their own; sets are compared by sums of hashes, never collected."""
    marks = covered.select(key, "cell").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("cell").cast("decimal(38,0)")).alias("h"), F.bit_xor(F.xxhash64(F.lit(7), "cell")).alias("x"))
    return marks.groupBy("n", "h", "x").agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.lit(1)).alias("n_sets"), F.sum("c").alias("n_candidates")).withColumn("ratio", F.col("n_sets") / F.col("n_candidates"))


def greedy(covered: DataFrame, key: str, weights: DataFrame, weight: str, p: int, forced: DataFrame | None = None) -> DataFrame:
    """Greedy maximal covering: p sites, each with the largest weight not yet covered (least key on a tie).

    Two aggregates a step; what is left uncovered is stored each step, so the plan stays short. Forced sites cover first.
    """
    from hexsite.sources.shared import stored

    spark = covered.sparkSession
    gain = covered.join(weights.select("cell", weight), "cell")
    if forced is not None:
        seen = gain.join(forced.select(key), key, "left_semi").select("cell").distinct()
        gain = gain.join(seen, "cell", "left_anti")
    chosen = []
    for step in range(p):
        gain = stored(gain, "greedy")
        best = gain.groupBy(key).agg(F.sum(weight).alias("g")).orderBy(F.desc(F.round("g", 6)), key).first()
        if best is None or best["g"] <= 0:
            break
        chosen.append((step, best[key], float(best["g"])))
        gain = gain.join(gain.filter(F.col(key) == best[key]).select("cell"), "cell", "left_anti")
    return spark.createDataFrame(chosen, f"step int, {key} {dict(covered.dtypes)[key]}, gain double")

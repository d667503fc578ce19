"""Entity resolution between stations and a registry, and physical duplicates within stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexsite.config import DEFAULT, Thresholds
from hexsite.functions.columns import identity, plain_text, same_identity, truth
from hexsite.functions.geo import coordinates_valid, haversine_m
from hexsite.functions.similarity import name_similarity
from hexsite.operators.graph import components
from hexsite.operators.spatial import accept_first, self_pairs, within


def match(stations: DataFrame, registry: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """code, store, method, dist_m, sim of stations (code, name, lat, lng) against a registry (store, name, lat, lng).

    The same code always wins. Of the rest, with coordinates: the nearest store within the radius that is very near or
    has a like name; not the best name. Names are compared only where the join in space has left a pair.
    """
    r = registry.select(F.col("store").alias("_store"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("name").alias("_name"))
    both = stations.join(r, F.col("code") == F.col("_store"))
    ok = coordinates_valid("lat", "lng", t) & coordinates_valid("_lat", "_lng", t)
    exact = both.select("code", F.col("_store").alias("store"), F.when(ok, "exact_code").otherwise("exact_code_no_coord").alias("method"), F.when(ok, haversine_m("lat", "lng", "_lat", "_lng")).alias("dist_m"), F.lit(None).cast("double").alias("sim"))
    rest = stations.join(exact.select("code"), "code", "left_anti").filter(coordinates_valid("lat", "lng", t)).select("code", "name", "lat", "lng")
    pairs = within(rest, registry.filter(coordinates_valid("lat", "lng", t)).select("store", "name", "lat", "lng"), t.match_radius_m)
    pairs = pairs.withColumn("sim", name_similarity(plain_text(F.col("name")), plain_text(F.col("r_name"))))
    near = accept_first(pairs, "code", (F.col("dist_m") <= t.match_near_m) | (F.col("sim") >= t.match_name), "dist_m", "r_store")
    fuzzy = near.select("code", F.col("r_store").alias("store"), F.lit("spatial_fuzzy").alias("method"), "dist_m", "sim")
    found = exact.unionByName(fuzzy)
    return stations.select("code").join(found, "code", "left").withColumn("method", F.coalesce("method", F.lit("none")))


def expected(network: Column, kind: Column, code: Column) -> Column:
    """Whether the registry should have the station."""
    n = F.lower(F.coalesce(network, F.lit("")))
    return (n.contains("vin") | n.contains("vgreen")) & (truth(kind == "VINFAST_CS") | truth(code.startswith("C.")))


def verified(t: Thresholds = DEFAULT) -> Column:
    by_name = truth(F.col("sim") >= t.match_name) & truth(F.col("dist_m") <= t.match_radius_m)
    return F.when(F.col("method") == "exact_code", truth(F.col("dist_m") <= t.match_verify_m)).when(F.col("method") == "spatial_fuzzy", by_name).otherwise(F.lit(False))


def confidence(completeness: Column, is_expected: Column, is_verified: Column) -> Column:
    """Completeness, blended with the match's score where the registry should have the station."""
    score = (
        F.when(F.col("method") == "exact_code", F.when(is_verified, 1.0).otherwise(0.6))
        .when(F.col("method") == "exact_code_no_coord", 0.6)
        .when(F.col("method") == "spatial_fuzzy", F.coalesce(0.5 + 0.4 * F.least(F.col("sim"), F.lit(100.0)) / 100, F.lit(0.5)))
        .otherwise(0.0)
    )
    return F.bround(F.when(is_expected, 0.4 * completeness + 0.6 * score).otherwise(completeness), 3)


def with_fallback(df: DataFrame) -> DataFrame:
    """Where a station has no match (official_matched is null): its completeness as confidence, not verified, the live source as
    provenance, no method."""
    has = F.col("official_matched").isNotNull()
    return df.withColumns({
        "confidence": F.bround(F.when(has, F.col("confidence")).otherwise(F.col("completeness")).cast("double"), 3),
        "verified": truth(F.when(has, F.col("verified"))),
        "provenance": F.coalesce(F.when(has, F.col("provenance")), F.lit("evcs.vn")),
        "match_method": F.coalesce("match_method", F.lit("none")),
        "official_matched": truth("official_matched"),
    })


def with_xref(stations: DataFrame, xref: DataFrame, digest: str, columns: list[str]) -> DataFrame:
    """Stations with what a cross-reference says of them, by station_code. It must be of just this catalogue (one digest, that
    given), have each code once, and know every code that is asked for; else it is stale, and ValueError says how."""
    seen = [r["h"] for r in xref.select(F.col("source_master_sha256").alias("h")).filter("h IS NOT NULL").distinct().limit(2).collect()]
    if seen != [digest]:
        raise ValueError("the cross-reference is of another catalogue")
    if xref.groupBy("station_code").count().filter("count > 1").limit(1).count():
        raise ValueError("codes of the cross-reference repeat")
    if lost := stations.join(xref, "station_code", "left_anti").count():
        raise ValueError(f"{lost} stations aren't in the cross-reference")
    own = xref.select("station_code", *columns)
    out = stations.drop(*columns).join(own, "station_code", "left")
    return out.withColumn("has_xref", F.col("official_matched").isNotNull()) if "official_matched" in columns else out


def completeness(*present: Column) -> Column:
    """Mean of indicators, null being absent."""
    return sum((truth(p).cast("double") for p in present), F.lit(0.0)) / len(present)


def with_survivor(df: DataFrame) -> DataFrame:
    """survivor of each group and is_primary: an exact match before others, a match, the higher confidence (null last), a series,
    the least id. An aggregate, as a group may be large."""
    better = lambda c: ~truth(F.col(c))
    order = F.struct(better("exact"), better("matched"), F.col("confidence").isNull(), -F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)), better("has_series"), F.col("id"))
    best = df.groupBy("group").agg(F.min_by("id", order).alias("survivor"))
    return df.join(best, "group").withColumn("is_primary", F.col("survivor") == F.col("id"))


def physical_duplicates(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Groups of rows that are one station, and each group's survivor.

    Reads id (text), name, address, lat, lng, store (null or text), own_code, exact, matched, confidence, has_series.
    Rows of one store are one station. Rows within the radius are, if their names say the same place, unless they
    belong to a blob of ``stack_min`` or more rows, or registry entries of their own say otherwise.
    """
    same_store = df.filter(F.col("store").isNotNull() & (F.col("store") != "")).select("id", "store")
    first = same_store.groupBy("store").agg(F.min("id").alias("a"))
    by_store = same_store.join(first, "store").filter(F.col("id") != F.col("a")).select("a", F.col("id").alias("b"))

    base = df.select("id", "lat", "lng", "store", "own_code", identity(F.col("name"), F.col("address")).alias("who"))
    near = self_pairs(base, "id", t.dup_radius_m)
    blobs = components(near.select(F.col("id").alias("a"), F.col("r_id").alias("b")))
    suspect = blobs.join(blobs.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").filter(F.col("size") >= t.stack_min).select(F.col("node").alias("id"))
    own = lambda p: truth(F.col(f"{p}store") != F.col(f"{p}own_code"))
    independent = truth(F.col("store") != F.col("r_store")) & (own("") | own("r_"))
    alike = near.filter(same_identity(F.col("who"), F.col("r_who")) & ~independent).select(F.col("id").alias("a"), F.col("r_id").alias("b"))
    alike = alike.join(suspect.select(F.col("id").alias("a")), "a", "left_anti").join(suspect.select(F.col("id").alias("b")), "b", "left_anti").select("a", "b")

    groups = components(by_store.unionByName(alike))
    named = df.join(groups, F.col("id") == F.col("node"), "left").withColumn("group", F.coalesce("component", "id")).drop("node", "component")
    out = with_survivor(named)
    return out.join(suspect.withColumn("blob", F.lit(True)), "id", "left").withColumn("blob", truth("blob"))

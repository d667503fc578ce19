"""Supply: status, masks, reasons, survivors."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.functions.columns import province_code, slug, valid_code
from hexsite.functions.geo import coordinates_valid
from hexsite.operators import supply as S
from hexsite.plans.catalogue import query
from hexsite.plans.projections import oracle, view

RESOLVED = """
WITH r AS (
  SELECT *, coalesce(
      CASE registry_status WHEN 'ACTIVE' THEN 'OPERATIONAL' WHEN 'BUSY' THEN 'OPERATIONAL' WHEN 'INACTIVE' THEN 'MAINTENANCE' WHEN 'OUTOFSERVICE' THEN 'OUT_OF_SERVICE' WHEN 'UNAVAILABLE' THEN 'OUT_OF_SERVICE' END,
      CASE live_status WHEN 'Available' THEN 'OPERATIONAL' WHEN 'AllBusy' THEN 'OPERATIONAL' WHEN 'Maintaining' THEN 'MAINTENANCE' WHEN 'OutOfService' THEN 'OUT_OF_SERVICE' END, 'UNKNOWN') AS op_status,
    coalesce(CASE registry_access WHEN 'Public' THEN 'PUBLIC' WHEN 'Restricted' THEN 'RESTRICTED' END, CASE WHEN is_public THEN 'PUBLIC' WHEN NOT is_public THEN 'RESTRICTED' END, 'UNKNOWN') AS access
  FROM sites),
m AS (SELECT *, op_status <> 'OUT_OF_SERVICE' AND access = 'PUBLIC' AND coalesce(is_primary, false) AND coord_resolved AS in_supply FROM r),
x AS (
  SELECT *, CASE WHEN in_supply THEN NULL WHEN NOT coalesce(is_primary, false) THEN 'CROSS_SOURCE_DUP' WHEN access = 'UNKNOWN' THEN 'ACCESS_UNKNOWN'
      WHEN op_status = 'OUT_OF_SERVICE' THEN 'OUT_OF_SERVICE' WHEN NOT coord_resolved AND outside_admin THEN 'COORD_OUTSIDE_ADMIN'
      WHEN NOT coord_resolved THEN 'COORD_PLACEHOLDER' WHEN access = 'RESTRICTED' THEN 'RESTRICTED' END AS reason FROM m)
"""


def sites(spark, sf_dir):
    """Sites with the flags that the projection's markers stand for."""
    df = view(spark, sf_dir, "sites")
    flags = F.array_compact(F.array(F.when(F.col("outside_admin"), "COORD_OUTSIDE_ADMIN"), F.when(F.col("dirty"), "COORD_INVALID")))
    return S.resolve_status(df.withColumn("flags", flags))


@query("q0_supply_by_reason", oracle(RESOLVED + "SELECT coalesce(reason, 'SUPPLY') AS reason, count(*) AS n FROM x GROUP BY 1"))
def supply_by_reason(spark, sf_dir):
    return sites(spark, sf_dir).groupBy(F.coalesce(S.exclusion_reason(), F.lit("SUPPLY")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("flt13_status_access", oracle(RESOLVED + """
SELECT site_id, op_status, access, op_status <> 'OUT_OF_SERVICE' AS is_operational,
  concat_ws(';', CASE WHEN outside_admin THEN 'COORD_OUTSIDE_ADMIN' END, CASE WHEN dirty THEN 'COORD_INVALID' END,
    CASE op_status WHEN 'OUT_OF_SERVICE' THEN 'NOT_OPERATIONAL' WHEN 'MAINTENANCE' THEN 'UNDER_MAINTENANCE' WHEN 'UNKNOWN' THEN 'STATUS_UNKNOWN' END,
    CASE access WHEN 'RESTRICTED' THEN 'NON_PUBLIC' WHEN 'UNKNOWN' THEN 'ACCESS_UNKNOWN' END) AS flags
FROM x"""))
def status_access(spark, sf_dir):
    return sites(spark, sf_dir).select("site_id", "op_status", "access", "is_operational", F.array_join("flags", ";").alias("flags"))


@query("flt2_supply_mask", oracle(RESOLVED + "SELECT site_id, province, score FROM x WHERE in_supply"))
def supply_mask(spark, sf_dir):
    return S.split_supply(sites(spark, sf_dir))[0].select("site_id", "province", "score")


@query("flt6_exclusion_reason", oracle(RESOLVED + "SELECT site_id, reason FROM x WHERE NOT in_supply"))
def exclusion_reason(spark, sf_dir):
    return S.split_supply(sites(spark, sf_dir))[1].select("site_id", "reason")


@query("flt3_baseline_counters", oracle(RESOLVED + """
SELECT count(*) AS n_total, count_if(in_supply AND NOT dirty) AS n_baseline, count_if(in_supply AND NOT dirty AND op_status = 'OPERATIONAL') AS n_operational,
  count_if(op_status = 'OUT_OF_SERVICE') AS n_not_operational, count_if(access <> 'PUBLIC') AS n_not_public, count_if(NOT coalesce(is_primary, false)) AS n_not_primary,
  count_if(NOT coord_resolved) AS n_unresolved, count_if(dirty) AS n_dirty FROM x"""))
def baseline_counters(spark, sf_dir):
    return S.baseline_counters(sites(spark, sf_dir))


@query("flt4_operational_only", oracle(RESOLVED + "SELECT site_id FROM x WHERE in_supply AND NOT dirty AND op_status = 'OPERATIONAL'"))
def operational_only(spark, sf_dir):
    return sites(spark, sf_dir).filter(S.baseline_mask() & (F.col("op_status") == "OPERATIONAL")).select("site_id")


@query("flt9_coordinates_valid", oracle("SELECT site_id, coalesce(lat BETWEEN 8e0 AND 23.6e0 AND lng BETWEEN 102e0 AND 110e0, false) AS ok FROM sites"))
def coordinates(spark, sf_dir):
    return view(spark, sf_dir, "sites").select("site_id", coordinates_valid("lat", "lng").alias("ok"))


@query("flt10_has_dirty_flag", oracle("SELECT site_id FROM sites WHERE dirty"))
def dirty(spark, sf_dir):
    return sites(spark, sf_dir).filter(S.has_any(F.col("flags"), S.DIRTY)).select("site_id")


@query("ag22_exclusion_shares", oracle(RESOLVED + """
SELECT coalesce(reason, 'SUPPLY') AS reason, count(*) AS n, round(count(*) * 1e0 / sum(count(*)) OVER (), 6) AS share FROM x GROUP BY 1"""))
def exclusion_shares(spark, sf_dir):
    counts = supply_by_reason(spark, sf_dir)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("reason", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))  # one row is broadcast


@query("ag23_capacity", oracle(RESOLVED + "SELECT province, round(sum(CASE WHEN coord_resolved THEN score END), 4) AS amount, count_if(NOT coord_resolved) AS n_unknown, count(*) AS n FROM x GROUP BY province"))
def capacity(spark, sf_dir):
    return S.capacity(sites(spark, sf_dir), "province", "score", "coord_resolved").withColumn("amount", F.round("amount", 4))


@query("st1_slug", oracle("SELECT site_id, 'vn-' || trim(regexp_replace(lower(code || ' / ' || name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, regexp_extract(code, '^C\\.([A-Z]+)\\d', 1) AS province_code, regexp_matches(code, '^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$') AS ok FROM sites"))
def slugs(spark, sf_dir):
    both = F.concat("code", F.lit(" / "), "name")
    return view(spark, sf_dir, "sites").select("site_id", slug(both).alias("slug"), province_code(F.col("code")).alias("province_code"), valid_code(F.col("code")).alias("ok"))


@query("flt1_in_scope", oracle("SELECT site_id FROM sites WHERE site_id % 9 <> 0"))
def in_scope(spark, sf_dir):
    kind = F.when(F.col("site_id") % 9 == 0, "BATTERY_SWAP").when(F.col("site_id") % 4 != 0, "VINFAST_CS")
    return S.in_scope(view(spark, sf_dir, "sites").withColumn("station_type", kind)).select("site_id")


@query("flt8_national_area", oracle("SELECT site_id, lat + (site_id % 40) / 10e0 BETWEEN 8e0 AND 23.7e0 AND lng + (site_id % 70) / 10e0 BETWEEN 102e0 AND 110e0 AS inside FROM sites"))
def national(spark, sf_dir):
    from hexsite.functions.geo import resolve_area

    s = view(spark, sf_dir, "sites").select("site_id", (F.col("lat") + (F.col("site_id") % 40) / F.lit(10.0)).alias("lat"), (F.col("lng") + (F.col("site_id") % 70) / F.lit(10.0)).alias("lng"))
    return s.select("site_id", resolve_area(None).contains("lat", "lng").alias("inside"))


@query("flt11_keywords", oracle("SELECT c_custkey AS k FROM customer WHERE regexp_matches(lower(c_name || ' ' || coalesce(c_mktsegment, '')), 'auto|house|00[13]$')"))
def keywords(spark, sf_dir):
    from hexsite.functions.columns import any_keyword
    from hexsite.plans.projections import tables

    c = tables(spark, sf_dir, "customer")["customer"]
    return c.filter(any_keyword(["auto", "house", "00[13]$"], F.col("c_name"), F.col("c_mktsegment"))).select(F.col("c_custkey").alias("k"))


@query("wn2_survivor", oracle("""
WITH s AS (SELECT site_id, province, site_id % 5 = 0 AS exact, site_id % 3 = 0 AS matched, round(score / 5000e0) AS confidence, site_id % 2 = 0 AS has_series FROM sites)
SELECT site_id, province, row_number() OVER w = 1 AS is_survivor, first_value(site_id) OVER w AS survivor FROM s
WINDOW w AS (PARTITION BY province ORDER BY exact DESC, matched DESC, confidence DESC, has_series DESC, site_id)"""))
def survivor(spark, sf_dir):
    from hexsite.operators.match import with_survivor

    i = F.col("site_id")
    s = view(spark, sf_dir, "sites").select(i.alias("id"), "site_id", F.col("province").alias("group"), (i % 5 == 0).alias("exact"), (i % 3 == 0).alias("matched"), F.round(F.col("score") / 5000).alias("confidence"), (i % 2 == 0).alias("has_series"))
    return with_survivor(s).select("site_id", F.col("group").alias("province"), F.col("is_primary").alias("is_survivor"), "survivor")


@query("flt5_anchor_filter", oracle(RESOLVED + """
SELECT site_id FROM x WHERE op_status <> 'OUT_OF_SERVICE' AND access <> 'RESTRICTED' AND coalesce(is_primary, false) AND coord_resolved
  AND 2e0 * 6371.0088e0 * asin(least(1e0, sqrt(pow(sin(radians(lat - 21.0278e0) / 2e0), 2e0) + cos(radians(21.0278e0)) * cos(radians(lat)) * pow(sin(radians(lng - 105.8342e0) / 2e0), 2e0)))) <= 30e0"""))
def anchor_filter(spark, sf_dir):
    from hexsite.functions.geo import resolve_area

    return S.anchors(sites(spark, sf_dir), resolve_area("hanoi").contains("lat", "lng")).select("site_id")

"""The remaining operators: roll-ups of the registry, stacks, zones, scores, labels, orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.functions import columns as K
from hexsite.functions import grid
from hexsite.functions.geo import resolve_area
from hexsite.operators import admin as A
from hexsite.operators import coords as Q
from hexsite.operators import demand as D
from hexsite.operators import gates as G
from hexsite.operators import match as M
from hexsite.operators import roads as R
from hexsite.operators import siting as P
from hexsite.operators import spatial as X
from hexsite.operators import stats as T
from hexsite.plans.catalogue import query

from hexsite.plans.projections import oracle, tables, view
from hexsite.plans.spatial_queries import ANCHORS, BOX, CELL, CLAT, CLNG, DIST, POP, _anchors, cells
from hexsite.plans.supply_queries import RESOLVED, sites

REGISTRY = """
WITH g AS (SELECT station % 100 AS store, kw, current_type FROM guns),
r AS (SELECT store, count(*) AS n, count_if(current_type = 'DC') AS n_dc, max(kw) AS max_kw, count(*) - count_if(current_type = 'DC') AS n_ac FROM g GROUP BY 1)
"""


def _registry_rollup(spark, sf_dir):
    g = view(spark, sf_dir, "guns").withColumn("store", F.col("station") % 100)
    r = g.groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("current_type") == "DC").alias("n_dc"), F.max("kw").alias("max_kw"))
    return r.withColumn("n_ac", F.col("n") - F.col("n_dc"))


@query("ag5_registry_rollup", oracle(REGISTRY + "SELECT * FROM r"))
def registry_rollup(spark, sf_dir):
    return _registry_rollup(spark, sf_dir)


@query("jn5_registry_enriched", oracle(REGISTRY + "SELECT s.store, n, max_kw, p.name AS province FROM registry s LEFT JOIN r ON s.store = r.store LEFT JOIN provinces p ON s.province = p.province"))
def registry_enriched(spark, sf_dir):
    s = view(spark, sf_dir, "registry").select("store", "province")
    p = view(spark, sf_dir, "provinces").select("province", "name")
    return s.join(_registry_rollup(spark, sf_dir), "store", "left").join(p, "province", "left").select("store", "n", "max_kw", F.col("name").alias("province"))


@query("jn3_map_lookup", oracle("SELECT s.site_id, p.name AS province_name FROM sites s LEFT JOIN provinces p ON s.province = p.province"))
def map_lookup(spark, sf_dir):
    return view(spark, sf_dir, "sites").select("site_id", "province").join(view(spark, sf_dir, "provinces").select("province", F.col("name").alias("province_name")), "province", "left").select("site_id", "province_name")


@query("jn9_range_same_class", oracle(f"SELECT a.poi AS a, b.poi AS b FROM poi a JOIN poi b ON a.poi < b.poi AND a.class = b.class WHERE {DIST} <= 700e0"))
def range_same_class(spark, sf_dir):
    p = view(spark, sf_dir, "poi").select("poi", "class", "lat", "lng")
    return X.self_pairs(p, "poi", 700.0, alike=("class",)).select(F.col("poi").alias("a"), F.col("r_poi").alias("b"))


ZONES = """z AS (SELECT lat0, lat1, lng0, lng1, CASE province % 3 WHEN 0 THEN 'MILITARY' WHEN 1 THEN 'PROTECTED' ELSE 'AIRPORT' END AS flag FROM provinces
  UNION ALL SELECT lat0 + 0.05e0, lat1 + 0.05e0, lng0 - 0.03e0, lng1 - 0.03e0, CASE province % 4 WHEN 0 THEN 'WATER_OSM' ELSE 'MILITARY' END FROM provinces)"""


@query("jn18_exclusion_zones", oracle(f"""
WITH {POP}, {ZONES}, c AS (SELECT cell, {CLAT} AS lat, {CLNG} AS lng FROM cells)
SELECT cell, string_agg(DISTINCT flag, ';' ORDER BY flag) AS flags FROM c JOIN z ON {BOX} GROUP BY 1"""))
def exclusion_zones(spark, sf_dir):
    """Zones overlap, so most cells have two flags."""
    c = cells(spark, sf_dir).select("cell", grid.centre_lat("cell").alias("lat"), grid.centre_lng("cell").alias("lng"))
    p = view(spark, sf_dir, "provinces")
    one = p.select("lat0", "lat1", "lng0", "lng1", F.element_at(F.array(F.lit("MILITARY"), F.lit("PROTECTED"), F.lit("AIRPORT")), F.col("province") % 3 + 1).alias("flag"))
    two = p.select((F.col("lat0") + 0.05).alias("lat0"), (F.col("lat1") + 0.05).alias("lat1"), (F.col("lng0") - 0.03).alias("lng0"), (F.col("lng1") - 0.03).alias("lng1"), F.when(F.col("province") % 4 == 0, "WATER_OSM").otherwise("MILITARY").alias("flag"))
    return X.zone_flags(c, one.unionByName(two)).select("cell", F.array_join("flags", ";").alias("flags"))


STACK = "SELECT site_id, province, floor(lat * 50e0) / 50e0 AS lat, floor(lng * 50e0) / 50e0 AS lng FROM sites"


@query("ag9_stacks", oracle(f"WITH s AS ({STACK}) SELECT site_id, count(*) OVER (PARTITION BY round(lat, 6), round(lng, 6)) AS stack FROM s"))
def stacks(spark, sf_dir):
    s = view(spark, sf_dir, "sites").select("site_id", (F.floor(F.col("lat") * 50) / 50).alias("lat"), (F.floor(F.col("lng") * 50) / 50).alias("lng"))
    return Q.stacks(s, "site_id").select("site_id", "stack")


REPAIR = """
WITH s AS (SELECT site_id, CASE WHEN site_id % 17 = 0 THEN NULL WHEN site_id % 13 = 0 THEN 95e0 ELSE lat END AS lat, lng, site_id % 3 = 0 AS far, site_id % 8 AS stack, site_id % 2 = 0 AS suspect, CASE WHEN site_id % 5 = 0 THEN NULL ELSE lat + 0.01e0 END AS off_lat,
  CASE WHEN site_id % 5 = 0 THEN NULL WHEN site_id % 7 = 0 THEN 300e0 ELSE lng END AS off_lng, CAST(site_id % 200 AS DOUBLE) AS off_own_km, site_id % 7 AS off_stack FROM sites),
v AS (SELECT *, coalesce(lat BETWEEN 8e0 AND 23.6e0 AND lng BETWEEN 102e0 AND 110e0, false) AS ok, coalesce(off_lat BETWEEN 8e0 AND 23.6e0 AND off_lng BETWEEN 102e0 AND 110e0, false) AS off_ok FROM s),
b AS (SELECT *, (stack >= 5 AND far) OR (suspect AND stack >= 2 AND far) AS bad FROM v),
f AS (SELECT *, CASE WHEN NOT bad AND ok THEN 'TRUSTED' WHEN NOT bad THEN 'INVALID' WHEN ok AND off_ok AND off_own_km <= 100e0 AND off_stack < 5 THEN 'SNAPPED' ELSE 'UNRESOLVED' END AS fix FROM b),
n AS (SELECT site_id, fix, CASE fix WHEN 'TRUSTED' THEN lat WHEN 'SNAPPED' THEN off_lat END AS lat, CASE fix WHEN 'TRUSTED' THEN lng WHEN 'SNAPPED' THEN off_lng END AS lng FROM f)
"""


@query("ms9_repair", oracle(REPAIR + f"SELECT site_id, fix, fix IN ('TRUSTED', 'SNAPPED') AS coord_resolved, {CELL} AS cell FROM n"))
def repair(spark, sf_dir):
    i = F.col("site_id")
    lat = F.when(i % 17 == 0, None).when(i % 13 == 0, 95.0).otherwise(F.col("lat"))
    s = view(spark, sf_dir, "sites").withColumn("lat", lat).select(
        "site_id", "lat", "lng", (i % 3 == 0).alias("far"), (i % 8).alias("stack"), (i % 2 == 0).alias("suspect"), F.when(i % 5 != 0, F.col("lat") + 0.01).alias("off_lat"),
        F.when(i % 5 != 0, F.when(i % 7 == 0, 300.0).otherwise(F.col("lng"))).alias("off_lng"), (i % 200).cast("double").alias("off_own_km"), (i % 7).alias("off_stack"),
    )
    return Q.repair(s).select("site_id", "fix", "coord_resolved", "cell")


@query("ag21_retotal", oracle(f"""
WITH {POP}, l AS (SELECT cell, pop, CASE WHEN cell % 23 = 0 THEN NULL ELSE cell % 40 END AS commune, CASE WHEN cell % 40 < 35 THEN CAST(cell % 9 AS DOUBLE) ELSE 0e0 END AS built, pop > 2500e0 AS bad, CASE WHEN cell % 40 % 9 = 0 THEN 0e0 ELSE 1e4 + CAST(cell % 40 AS DOUBLE) * 1500e0 END AS census FROM cells),
m AS (SELECT DISTINCT -1 - cell AS cell, cell % 40 AS commune, 2e0 AS built FROM cells WHERE cell % 6 = 0),
a AS (SELECT cell, 0e0 AS pop, commune, built FROM m UNION ALL SELECT cell, pop, commune, built FROM l),
s AS (SELECT commune, sum(pop) AS p, sum(built) AS b FROM a WHERE commune IS NOT NULL GROUP BY 1),
h AS (SELECT commune, bool_or(bad) AS hit, max(census) AS c FROM l WHERE commune IS NOT NULL GROUP BY 1),
k AS (SELECT s.commune, p, b, c, coalesce(hit, false) AND b > 0 AS moves, coalesce(c > 0 AND p > 1.5e0 * c, false) AS far FROM s LEFT JOIN h ON s.commune = h.commune)
SELECT cell, round(CASE WHEN coalesce(moves, false) THEN CASE WHEN far THEN 0.859e0 * c ELSE p END * built / b ELSE pop END, 5) AS pop_new,
  CASE WHEN coalesce(moves, false) THEN CASE WHEN far THEN 'RETOTALED_DANSO' ELSE 'REDISTRIBUTED' END WHEN bad AND l.commune IS NOT NULL THEN 'UNREPAIRED_NO_BUILTUP' ELSE 'WORLDPOP' END AS pop_src FROM l LEFT JOIN k ON l.commune = k.commune
UNION ALL SELECT cell, round(CASE WHEN far THEN 0.859e0 * c ELSE p END * built / b, 5), CASE WHEN far THEN 'RETOTALED_DANSO' ELSE 'REDISTRIBUTED' END FROM m JOIN k ON m.commune = k.commune WHERE moves"""))
def retotal(spark, sf_dir):
    """Some communes have a census of 0, and some built-up cells aren't in the table."""
    c = F.col("cell")
    census = F.when(c % 40 % 9 == 0, 0.0).otherwise(1e4 + (c % 40).cast("double") * 1500)
    base = cells(spark, sf_dir).select("cell", "pop", F.when(c % 23 != 0, c % 40).alias("commune"), F.when(c % 40 < 35, (c % 9).cast("double")).otherwise(0.0).alias("built"), census.alias("census"))
    empty = base.filter("cell % 6 = 0").select((-1 - c).alias("cell"), (c % 40).alias("commune"), F.lit(2.0).alias("built"))
    return D.retotal(base, bad=F.col("pop") > 2500, empty=empty).select("cell", F.round("pop_new", 5).alias("pop_new"), "pop_src")


@query("wn3_class_priority", oracle("SELECT poi % 500 AS object, arg_min(class, CASE class WHEN 'FUEL' THEN 0 WHEN 'MALL' THEN 1 WHEN 'DEPT_STORE' THEN 2 WHEN 'SUPERMARKET' THEN 3 WHEN 'MARKET' THEN 4 WHEN 'PARKING_OFF' THEN 5 ELSE 6 END) AS class FROM poi GROUP BY 1"))
def class_priority(spark, sf_dir):
    order = ["FUEL", "MALL", "DEPT_STORE", "SUPERMARKET", "MARKET", "PARKING_OFF", "APARTMENT"]
    rank = K.lookup(F.col("class"), {c: i for i, c in enumerate(order)})
    return view(spark, sf_dir, "poi").groupBy((F.col("poi") % 500).alias("object")).agg(F.min_by("class", rank).alias("class"))


@query("st8_split_flags", oracle("SELECT p_partkey AS k, len(list_filter(string_split(replace(p_name, ' ', ';') || ';;', ';'), lambda x: x <> '')) AS n FROM part"))
def split_flags(spark, sf_dir):
    p = tables(spark, sf_dir, "part")["part"]
    return p.select(F.col("p_partkey").alias("k"), F.size(K.split_flags(F.concat(F.regexp_replace("p_name", " ", ";"), F.lit(";;")))).cast("long").alias("n"))


@query("st9_power_label", oracle("SELECT DISTINCT current_type, kw, current_type || '-' || regexp_replace(printf('%.3f', kw), '\\.?0+$', '') || 'kW' AS label FROM guns"))
def labels(spark, sf_dir):
    return view(spark, sf_dir, "guns").select("current_type", "kw", K.power_label(F.col("current_type"), F.col("kw")).alias("label")).distinct()


@query("st10_commune_kind", oracle("SELECT n_nationkey AS k, CASE n_nationkey % 5 WHEN 0 THEN 'PHUONG' WHEN 1 THEN 'XA' WHEN 2 THEN 'DAC_KHU' ELSE 'UNKNOWN' END AS kind FROM nation"))
def commune_kind(spark, sf_dir):
    n = tables(spark, sf_dir, "nation")["nation"]
    name = F.concat(F.element_at(F.array(F.lit("Phường "), F.lit("Xã "), F.lit("Đặc khu "), F.lit("Tỉnh "), F.lit("Xãm ")), (F.col("n_nationkey") % 5 + 1).cast("int")), "n_name")
    return n.select(F.col("n_nationkey").alias("k"), K.commune_kind(name).alias("kind"))


@query("st11_corroborated", oracle("SELECT s_suppkey AS k, length(n_name) >= 4 AND s_suppkey % 3 <> 0 AS ok FROM supplier JOIN nation ON s_nationkey = n_nationkey"))
def corroborated(spark, sf_dir):
    """Two thirds of the addresses hold the commune's name, in capitals and with another prefix; every third doesn't."""
    t = tables(spark, sf_dir, "supplier", "nation")
    both = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    address = F.when(F.col("s_suppkey") % 3 == 0, "12 đường số 4").otherwise(F.concat(F.lit("12 đường số 4, phường "), F.upper("n_name")))
    return both.select(F.col("s_suppkey").alias("k"), K.corroborated(F.concat(F.lit("Xã "), F.initcap("n_name")), address, F.col("s_name")).alias("ok"))


A_BOX = resolve_area("haiphong").box()


@query("ge5_area_box", oracle(f"SELECT count(*) AS n FROM sites WHERE lat BETWEEN {A_BOX[0]!r}e0 AND {A_BOX[1]!r}e0 AND lng BETWEEN {A_BOX[2]!r}e0 AND {A_BOX[3]!r}e0"))
def area_box(spark, sf_dir):
    a, b, c, d = resolve_area("haiphong").box()
    return view(spark, sf_dir, "sites").filter(F.col("lat").between(a, b) & F.col("lng").between(c, d)).agg(F.count(F.lit(1)).alias("n"))


@query("ge12_gap_score", oracle(f"WITH {POP} SELECT cell, round(pop + 50 * (cell % 5) + 0.025e0 * (cell % 700) + 0.05e0 * (cell % 300), 6) AS score FROM cells"))
def gap_score(spark, sf_dir):
    c = F.col("cell")
    return cells(spark, sf_dir).select("cell", F.round(P.gap_score(F.col("pop"), c % 5, c % 700, c % 300), 6).alias("score"))


CONF = """
WITH s AS (SELECT site_id, registry_status IS NOT NULL AS i1, live_status IS NOT NULL AS i2, coord_resolved AS i3, coalesce(is_primary, false) AS i4, registry_access = 'Public' AND code LIKE 'C.%' AS e0,
  CASE site_id % 4 WHEN 0 THEN 'exact_code' WHEN 1 THEN 'exact_code_no_coord' WHEN 2 THEN 'spatial_fuzzy' ELSE 'none' END AS method, CAST(site_id % 300 AS DOUBLE) AS dist_m, CASE WHEN site_id % 7 = 0 THEN NULL ELSE 60e0 + CAST(site_id % 41 AS DOUBLE) END AS sim FROM sites),
k AS (SELECT *, ((CASE WHEN i1 THEN 1e0 ELSE 0e0 END) + (CASE WHEN i2 THEN 1e0 ELSE 0e0 END) + (CASE WHEN i3 THEN 1e0 ELSE 0e0 END) + (CASE WHEN i4 THEN 1e0 ELSE 0e0 END)) / 4 AS comp,
  CASE method WHEN 'exact_code' THEN dist_m <= 200e0 WHEN 'spatial_fuzzy' THEN coalesce(sim >= 82e0, false) AND dist_m <= 250e0 ELSE false END AS verified FROM s)
"""


@query("ge14_confidence", oracle(CONF + """
SELECT site_id, comp AS completeness, verified, round_even(CASE WHEN coalesce(e0, false) THEN 0.4e0 * comp + 0.6e0 * CASE method WHEN 'exact_code' THEN CASE WHEN verified THEN 1e0 ELSE 0.6e0 END WHEN 'exact_code_no_coord' THEN 0.6e0
  WHEN 'spatial_fuzzy' THEN coalesce(0.5e0 + 0.4e0 * least(sim, 100e0) / 100, 0.5e0) ELSE 0e0 END ELSE comp END, 3) AS confidence FROM k"""))
def confidence(spark, sf_dir):
    i = F.col("site_id")
    method = F.element_at(F.array(F.lit("exact_code"), F.lit("exact_code_no_coord"), F.lit("spatial_fuzzy"), F.lit("none")), (i % 4 + 1).cast("int"))
    s = view(spark, sf_dir, "sites").withColumn("method", method).withColumn("dist_m", (i % 300).cast("double")).withColumn("sim", F.when(i % 7 != 0, 60.0 + (i % 41).cast("double")))
    s = s.withColumn("completeness", M.completeness(F.col("registry_status").isNotNull(), F.col("live_status").isNotNull(), F.col("coord_resolved"), F.col("is_primary"))).withColumn("verified", M.verified())
    known = M.expected(F.when(F.col("registry_access") == "Public", "VinFast"), F.lit("OTHER"), F.col("code"))
    return s.select("site_id", "completeness", "verified", M.confidence(F.col("completeness"), known, F.col("verified")).alias("confidence"))


@query("ge16_land_support", oracle(f"WITH {POP} SELECT cell, CAST(cell % 10 AS DOUBLE) / 10e0 > 0.8e0 AND pop > 100 AS on_water, CAST(cell % 7 AS DOUBLE) / 100e0 < 0.02e0 AND pop > 500 AS no_built FROM cells"))
def land_support(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("frac_water", (F.col("cell") % 10).cast("double") / 10).withColumn("built", (F.col("cell") % 7).cast("double") / 100)
    flags = D.land_support()
    return c.select("cell", flags["POP_ON_WATER"].alias("on_water"), flags["POP_NO_BUILT"].alias("no_built"))


@query("ge18_capex", oracle(ANCHORS + "SELECT CASE WHEN tier = 'T0' THEN 'low' WHEN (cell % 100) / 100e0 >= 0.5e0 THEN 'high' ELSE 'mid' END AS capex, count(*) AS n FROM k GROUP BY 1"))
def capex(spark, sf_dir):
    a = _anchors(spark, sf_dir).withColumn("penalty", (F.col("cell") % 100) / 100)
    return a.groupBy(P.capex_class(F.col("tier"), F.col("penalty")).alias("capex")).agg(F.count(F.lit(1)).alias("n"))


@query("ms6_outside_disks", oracle(f"SELECT site_id FROM sites a WHERE NOT EXISTS (SELECT 1 FROM registry b WHERE b.store % 3 > 0 AND {DIST} <= CAST(b.store % 3 AS DOUBLE) * 1500e0)"))
def outside_disks(spark, sf_dir):
    r = view(spark, sf_dir, "registry").withColumn("radius", (F.col("store") % 3).cast("double") * 1500)
    return X.outside_all(view(spark, sf_dir, "sites"), "site_id", r, "radius", 3000.0).select("site_id")


@query("ms7_checkpoint_valid", oracle("SELECT 'codes' AS gate, CASE WHEN count_if(NOT regexp_matches(code, '^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$')) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM sites UNION ALL SELECT 'unique', CASE WHEN count(*) = count(DISTINCT code) THEN 'PASS' ELSE 'FAIL' END FROM sites UNION ALL SELECT 'north', CASE WHEN count_if(lat < 20.7e0) = 0 THEN 'PASS' ELSE 'FAIL' END FROM sites"))
def checkpoint(spark, sf_dir):
    checks = [G.none_where("codes", ~K.valid_code(F.col("code"))), G.unique("unique", "code"), G.none_where("north", F.col("lat") < 20.7)]
    return G.evaluate(view(spark, sf_dir, "sites"), checks).select("gate", "status")


@query("ms11_admin_verdict", oracle("""
WITH s AS (SELECT site_id, coord_resolved AS has, dirty AS flagged, site_id % 6 = 0 AS outside, site_id % 7 = 0 AND site_id % 6 <> 0 AS snapped, site_id % 2 = 0 AS ok, province FROM sites),
v AS (SELECT *, CASE WHEN NOT has THEN 'NO_COORD' WHEN outside THEN 'COORD_BAD' WHEN flagged AND ok THEN 'COORD_CONFIRMED' WHEN flagged THEN 'UNRESOLVED' ELSE 'NOT_FLAGGED' END AS verdict FROM s)
SELECT site_id, verdict, has AND NOT outside AS coord_resolved, CASE WHEN has AND outside THEN NULL ELSE site_id END AS cell, CASE WHEN has AND outside THEN 'outside_admin' ELSE 'evcs' END AS coord_src,
  CASE WHEN has AND NOT outside THEN province END AS commune, CASE WHEN NOT (has AND NOT outside) THEN 'unresolved' WHEN snapped THEN 'nearest' ELSE 'inside' END AS method,
  concat_ws(';', CASE WHEN flagged THEN 'COORD_ADDR_MISMATCH' END, CASE WHEN has AND outside THEN 'COORD_OUTSIDE_ADMIN' END, CASE WHEN snapped THEN 'ADMIN_COORD_SNAPPED' END) AS flags FROM v"""))
def admin_verdict(spark, sf_dir):
    """The verdict with its effects; a station outside every unit is bad whether it was flagged or not."""
    i = F.col("site_id")
    outside = i % 6 == 0
    s = view(spark, sf_dir, "sites").select(
        "site_id", "coord_resolved", F.col("dirty").alias("flagged"), i.alias("cell"), F.lit("evcs").alias("coord_src"), F.when(~outside, F.col("province")).alias("commune"),
        F.when(outside, "none").when(i % 7 == 0, "nearest").otherwise("inside").alias("method"), F.when(F.col("dirty"), F.array(F.lit("COORD_ADDR_MISMATCH"))).alias("flags"),
    )
    s = s.withColumn("verdict", A.verdict(F.col("coord_resolved"), F.col("method") == "none", F.col("flagged"), i % 2 == 0))
    return A.ruled(s, ["commune"]).select("site_id", "verdict", "coord_resolved", "cell", "coord_src", "commune", "method", F.array_join("flags", ";").alias("flags"))


@query("ms12_province_conflict", oracle(f"""
WITH g AS (SELECT s.site_id, s.province AS own, (SELECT min(p.province) FROM provinces p WHERE s.lat BETWEEN p.lat0 AND p.lat1 AND s.lng BETWEEN p.lng0 AND p.lng1) AS seen FROM sites s),
c AS (SELECT own, seen, count(*) AS c FROM g WHERE seen IS NOT NULL GROUP BY 1, 2), m AS (SELECT own, arg_min(seen, (-c, seen)) AS label FROM c GROUP BY 1)
SELECT site_id, coalesce(label <> seen, false) AS conflict FROM g LEFT JOIN m ON g.own = m.own"""))
def province_conflict(spark, sf_dir):
    s = view(spark, sf_dir, "sites").select("site_id", "lat", "lng", F.col("province").alias("own"))
    seen = X.in_boxes(s, "site_id", view(spark, sf_dir, "provinces"), "province").withColumnRenamed("province", "seen")
    both = s.join(seen, "site_id").select("site_id", "own", "seen")
    label = T.mode(both, "own", "seen").select("own", F.col("seen").alias("label"))
    return both.join(label, "own", "left").select("site_id", K.truth(F.col("label") != F.col("seen")).alias("conflict"))


@query("ms16_tier_rank", oracle("SELECT p_partkey AS k, CASE p_size % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END AS rank FROM part"))
def tier_rank(spark, sf_dir):
    tier = F.element_at(F.array(*map(F.lit, ("DIRECT", "ADJACENT", "NEAR", "ISOLATED", "other"))), (F.col("p_size") % 5 + 1).cast("int"))
    return tables(spark, sf_dir, "part")["part"].select(F.col("p_partkey").alias("k"), D.tier_rank(tier).alias("rank"))


@query("ms20_tag_classes", oracle("""
SELECT p_partkey AS k, CASE p_size % 5 WHEN 0 THEN 'MILITARY' WHEN 1 THEN 'PROTECTED' WHEN 2 THEN 'AIRPORT' WHEN 3 THEN 'WATER_OSM' END AS exclusion,
  CASE p_size % 5 WHEN 0 THEN 'RESTRICTED' WHEN 1 THEN 'PUBLIC' ELSE 'UNKNOWN' END AS access, CASE p_size % 5 WHEN 2 THEN 'MARKET' ELSE 'SUPERMARKET' END AS class FROM part"""))
def tag_classes(spark, sf_dir):
    k = F.col("p_size") % 5
    tags = (
        F.when(k == 0, F.create_map(*map(F.lit, ("landuse", "military", "access", " Private ", "shop", "supermarket"))))
        .when(k == 1, F.create_map(*map(F.lit, ("leisure", "nature_reserve", "access", "customers", "shop", "convenience"))))
        .when(k == 2, F.create_map(*map(F.lit, ("aeroway", "runway", "amenity", "marketplace"))))
        .when(k == 3, F.create_map(*map(F.lit, ("natural", "water", "access", "unknown", "shop", "x"))))
        .otherwise(F.create_map(F.lit("shop"), F.lit("supermarket")))
    )
    p = tables(spark, sf_dir, "part")["part"].withColumn("tags", tags)
    return p.select(F.col("p_partkey").alias("k"), R.exclusion_tag(F.col("tags")).alias("exclusion"), R.poi_access(F.col("tags")).alias("access"), R.poi_class(F.lit("retail"), F.col("tags")).alias("class"))


@query("ms21_substations", oracle("SELECT DISTINCT round(lat, 2) AS lat, round(lng, 2) AS lng FROM poi WHERE class = 'FUEL' AND 2e0 * 6371.0088e0 * asin(least(1e0, sqrt(pow(sin(radians(lat - 21.0278e0) / 2e0), 2e0) + cos(radians(21.0278e0)) * cos(radians(lat)) * pow(sin(radians(lng - 105.8342e0) / 2e0), 2e0)))) <= 30e0"))
def substations(spark, sf_dir):
    p = view(spark, sf_dir, "poi").filter(F.col("class") == "FUEL").filter(resolve_area("hanoi").contains("lat", "lng"))
    return p.select(F.round("lat", 2).alias("lat"), F.round("lng", 2).alias("lng")).dropDuplicates()


@query("ms1_provenance", oracle("""
WITH s AS (SELECT site_id, registry_status IS NOT NULL AS i1, live_status IS NOT NULL AS i2, coord_resolved AS i3, coalesce(is_primary, false) AS i4 FROM sites),
c AS (SELECT site_id, (CAST(i1 AS INT) + CAST(i2 AS INT) + CAST(i3 AS INT) + CAST(i4 AS INT)) / 4e0 AS comp FROM s)
SELECT c.site_id, round_even(CASE WHEN r.store IS NOT NULL THEN abs(r.score) / 10000e0 ELSE comp END, 3) AS confidence, r.store IS NOT NULL AND r.store % 2 = 0 AS verified,
  CASE WHEN r.store IS NOT NULL THEN 'official' ELSE 'evcs.vn' END AS provenance, CASE WHEN r.store IS NOT NULL THEN 'exact_code' ELSE 'none' END AS match_method FROM c LEFT JOIN registry r ON c.site_id = r.store"""))
def provenance(spark, sf_dir):
    r = view(spark, sf_dir, "registry").select("store", (F.abs("score") / 10000).alias("confidence"), (F.col("store") % 2 == 0).alias("verified"), F.lit("official").alias("provenance"), F.lit("exact_code").alias("match_method"), F.lit(True).alias("official_matched"))
    s = view(spark, sf_dir, "sites")
    s = s.withColumn("completeness", M.completeness(F.col("registry_status").isNotNull(), F.col("live_status").isNotNull(), F.col("coord_resolved"), F.col("is_primary")))
    out = M.with_fallback(s.join(r, F.col("site_id") == F.col("store"), "left"))
    return out.select("site_id", "confidence", "verified", "provenance", "match_method")


@query("so2_reason_order", oracle(RESOLVED + """SELECT site_id, reason FROM x WHERE NOT in_supply ORDER BY CASE reason WHEN 'CROSS_SOURCE_DUP' THEN 1 WHEN 'ACCESS_UNKNOWN' THEN 2 WHEN 'OUT_OF_SERVICE' THEN 3
  WHEN 'COORD_PLACEHOLDER' THEN 4 WHEN 'COORD_OUTSIDE_ADMIN' THEN 5 ELSE 6 END, site_id"""))
def reason_order(spark, sf_dir):
    """All excluded sites, by the reason's priority and then by id."""
    from hexsite.operators import supply as S

    return S.reported(S.split_supply(sites(spark, sf_dir))[1].select("site_id", "reason"), "site_id")


@query("se4_split_and_join", oracle("SELECT poi FROM poi WHERE class <> 'APARTMENT' UNION ALL SELECT min(poi) FROM poi WHERE class = 'APARTMENT' GROUP BY poi % 100"))
def split_and_join(spark, sf_dir):
    p = view(spark, sf_dir, "poi")
    one = p.filter(F.col("class") == "APARTMENT").groupBy((F.col("poi") % 100).alias("complex")).agg(F.min("poi").alias("poi")).select("poi")
    return p.filter(F.col("class") != "APARTMENT").select("poi").unionByName(one)


@query("jn23_candidates_enriched", oracle(f"WITH {POP}, s AS (SELECT {CELL} AS cell, count(*) AS n_site FROM sites GROUP BY 1) SELECT cells.cell, round(pop, 6) AS pop, coalesce(n_site, 0) AS n_site FROM cells LEFT JOIN s USING (cell)"))
def enriched(spark, sf_dir):
    s = view(spark, sf_dir, "sites").groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.count(F.lit(1)).alias("n_site"))
    return cells(spark, sf_dir).join(s, "cell", "left").select("cell", F.round("pop", 6).alias("pop"), F.coalesce("n_site", F.lit(0)).alias("n_site"))


@query("iso_local_time", oracle("SELECT event_id, strftime(make_timestamp((event_id * 977777 + 25200) * 1000000), '%Y-%m-%d %H:%M:%S') AS t FROM events"))
def local_time(spark, sf_dir):
    return tables(spark, sf_dir, "events")["events"].select("event_id", K.local_time(F.col("event_id") * 977777000).alias("t"))

"""Grid, spatial joins, demand, feasibility and candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.functions.geo import haversine_sql, resolve_area
from hexsite.operators import demand as D
from hexsite.operators import siting as P
from hexsite.operators import spatial as X
from hexsite.operators import stats as T
from hexsite.operators.graph import components
from hexsite.plans.catalogue import query
from hexsite.plans.projections import oracle, view
from hexsite.sources.shared import stored

CELL = grid.cell_sql("lat", "lng")
CLAT, CLNG = grid.centre_sql("cell")
POP = f"cells AS (SELECT {CELL} AS cell, sum(pop) AS pop, count(*) AS n FROM pixels GROUP BY 1)"
DIST = haversine_sql("a.lat", "a.lng", "b.lat", "b.lng")


def cells(spark, sf_dir):
    return view(spark, sf_dir, "pixels").withColumn("cell", grid.cell_of("lat", "lng")).groupBy("cell").agg(F.sum("pop").alias("pop"), F.count(F.lit(1)).alias("n"))


@query("ge2_cell_of_point", oracle(f"SELECT site_id, {CELL} AS cell FROM sites"))
def cell_of_point(spark, sf_dir):
    return view(spark, sf_dir, "sites").select("site_id", grid.cell_of("lat", "lng").alias("cell"))


@query("ag11_raster_to_cells", oracle(f"WITH {POP} SELECT cell, round(pop, 6) AS pop, n FROM cells"))
def raster(spark, sf_dir):
    return cells(spark, sf_dir).withColumn("pop", F.round("pop", 6))


@query("ge3_cell_centres", oracle(f"WITH {POP} SELECT cell, round({CLAT}, 9) AS lat, round({CLNG}, 9) AS lng FROM cells"))
def centres(spark, sf_dir):
    return cells(spark, sf_dir).select("cell", F.round(grid.centre_lat("cell"), 9).alias("lat"), F.round(grid.centre_lng("cell"), 9).alias("lng"))


@query("flt7_area_contains", oracle(f"SELECT site_id, {haversine_sql('21.0278e0', '105.8342e0', 'lat', 'lng', 6371.0088)} <= 25e0 AS core, {haversine_sql('21.0278e0', '105.8342e0', 'lat', 'lng', 6371.0088)} <= 30e0 AS inside FROM sites"))
def area(spark, sf_dir):
    a = resolve_area("hanoi")
    return view(spark, sf_dir, "sites").select("site_id", a.core("lat", "lng").alias("core"), a.contains("lat", "lng").alias("inside"))


STEPS1, STEPS2 = grid.ring(1), grid.ring(2)
RINGS = f"""
WITH {POP},
s1 AS (SELECT unnest({STEPS1}) AS s), s2 AS (SELECT unnest({STEPS2}) AS s),
r1 AS (SELECT c.cell + s AS cell, sum(c.pop) AS v FROM cells c, s1 GROUP BY 1), r2 AS (SELECT c.cell + s AS cell, sum(c.pop) AS v FROM cells c, s2 GROUP BY 1),
r AS (SELECT c.cell, c.pop, coalesce(r1.v, 0) AS ring1, coalesce(r2.v, 0) AS ring2 FROM cells c LEFT JOIN r1 ON c.cell = r1.cell LEFT JOIN r2 ON c.cell = r2.cell)
"""


@query("gr7_ring_sums", oracle(RINGS + "SELECT cell, round(pop, 6) AS pop, round(ring1, 6) AS ring1, round(ring2, 6) AS ring2 FROM r"))
def ring_sums(spark, sf_dir):
    r = D.ring_sums(cells(spark, sf_dir), "pop", [1, 2])
    return r.select("cell", *[F.round(c, 6).alias(c) for c in ("pop", "ring1", "ring2")])


ROADS = RINGS.replace("WITH cells AS (", "WITH cells AS (").replace("sum(pop) AS pop", "sum(CASE WHEN pixel % 3 = 0 THEN pop ELSE 0e0 END) AS pop")


@query("ge10_access_tier", oracle(ROADS + "SELECT cell, CASE WHEN pop > 0 THEN 'DIRECT' WHEN ring1 > 0 THEN 'ADJACENT' WHEN ring2 > 0 THEN 'NEAR' ELSE 'ISOLATED' END AS tier FROM r"))
def access_tier(spark, sf_dir):
    roads = view(spark, sf_dir, "pixels").withColumn("cell", grid.cell_of("lat", "lng")).groupBy("cell").agg(F.sum(F.when(F.col("pixel") % 3 == 0, F.col("pop")).otherwise(0.0)).alias("road"))
    return D.ring_sums(roads, "road", [1, 2]).select("cell", D.access_tier(F.col("road"), F.col("ring1"), F.col("ring2")).alias("tier"))


@query("ag25_tier_shares", oracle(ROADS + ", a AS (SELECT @CELL@ AS cell, sum(pop) AS people FROM pixels GROUP BY 1), t AS (SELECT CASE WHEN pop > 0 THEN 'DIRECT' WHEN ring1 > 0 THEN 'ADJACENT' WHEN ring2 > 0 THEN 'NEAR' ELSE 'ISOLATED' END AS tier, people FROM r JOIN a USING (cell)) SELECT tier, count(*) AS cells, round(sum(people), 5) AS pop, round(sum(people) / sum(sum(people)) OVER (), 9) AS share FROM t GROUP BY 1".replace("@CELL@", CELL)))
def tier_shares(spark, sf_dir):
    both = access_tier(spark, sf_dir).join(cells(spark, sf_dir).select("cell", "pop"), "cell")
    return D.tier_summary(both, "tier").select("tier", "cells", F.round("pop", 5).alias("pop"), F.round("share", 9).alias("share"))


@query("gr8_tiers_of_some", oracle(ROADS + ", c AS (SELECT DISTINCT @CELL@ AS cell FROM poi) SELECT c.cell, CASE WHEN coalesce((SELECT sum(b.pop) FROM cells b WHERE b.cell = c.cell), 0) > 0 THEN 'DIRECT' WHEN (SELECT sum(b.pop) FROM cells b, s1 WHERE b.cell = c.cell + s1.s) > 0 THEN 'ADJACENT' WHEN (SELECT sum(b.pop) FROM cells b, s2 WHERE b.cell = c.cell + s2.s) > 0 THEN 'NEAR' ELSE 'ISOLATED' END AS access_tier FROM c".replace("@CELL@", CELL)))
def tiers_of_some(spark, sf_dir):
    roads = view(spark, sf_dir, "pixels").filter("pixel % 3 = 0").groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.sum("pop").alias("road_access"))
    return D.tiers_for(view(spark, sf_dir, "poi").select(grid.cell_of("lat", "lng").alias("cell")), roads)


def _cluster_sql(density: float, least: float, name: str) -> str:
    return f"""
    d{name} AS (SELECT cell, pop FROM cells WHERE pop / {grid.AREA_KM2!r}e0 >= {density!r}e0),
    e{name} AS (SELECT a.cell AS a, b.cell AS b FROM d{name} a, (SELECT unnest({STEPS1}) AS s) t, d{name} b WHERE b.cell = a.cell + t.s),
    w{name} AS (SELECT cell AS a, cell AS b FROM d{name} UNION SELECT w{name}.a, e{name}.b FROM w{name} JOIN e{name} ON w{name}.b = e{name}.a),
    k{name} AS (SELECT a AS cell, min(b) AS cluster FROM w{name} GROUP BY 1),
    t{name} AS (SELECT cluster, sum(pop) AS cluster_pop, count(*) AS cluster_cells FROM k{name} JOIN d{name} USING (cell) GROUP BY 1 HAVING sum(pop) >= {least!r}e0),
    c{name} AS (SELECT k.cell, k.cluster, t.cluster_pop, t.cluster_cells, rank AS cluster_rank FROM k{name} k JOIN (SELECT *, row_number() OVER (ORDER BY cluster_pop DESC, cluster) - 1 AS rank FROM t{name}) t USING (cluster))"""


@query("gr5_clusters", oracle(f"/* recursive */ WITH {POP}, {_cluster_sql(1500.0, 2000.0, '1')} SELECT cell, cluster, round(cluster_pop, 6) AS cluster_pop, cluster_cells, cluster_rank FROM c1".replace("/* recursive */ WITH", "WITH /* recursive */")))
def clusters(spark, sf_dir):
    return D.clusters(cells(spark, sf_dir), "pop", 1500.0, 2000.0).withColumn("cluster_pop", F.round("cluster_pop", 6)).withColumn("cluster_rank", F.col("cluster_rank").cast("long"))


@query("gr6_degurba", oracle(f"WITH /* recursive */ {POP}, {_cluster_sql(1500.0, 2000.0, '1')}, {_cluster_sql(1000.0, 1500.0, '2')} SELECT cells.cell, CASE WHEN c1.cell IS NOT NULL THEN 'URBAN_CENTRE' WHEN c2.cell IS NOT NULL THEN 'URBAN_CLUSTER' ELSE 'RURAL' END AS settlement_class, CAST(coalesce(c2.cluster_rank, -1) AS BIGINT) AS cluster_id, coalesce(c2.cluster_cells, 0) AS cluster_n_cells, CAST(coalesce(c1.cluster_rank, -1) AS BIGINT) AS centre_id, round(coalesce(c1.cluster_pop, 0), 5) AS centre_pop FROM cells LEFT JOIN c1 ON c1.cell = cells.cell LEFT JOIN c2 ON c2.cell = cells.cell"))
def degurba(spark, sf_dir):
    from hexsite.config import Thresholds

    t = Thresholds(dense_per_km2=1500.0, dense_total=2000.0, urban_per_km2=1000.0, urban_total=1500.0)
    return D.degree_of_urbanisation(cells(spark, sf_dir).select("cell", "pop"), "pop", t).select("cell", "settlement_class", F.col("cluster_id").cast("long").alias("cluster_id"), "cluster_n_cells", F.col("centre_id").cast("long").alias("centre_id"), F.round("centre_pop", 5).alias("centre_pop"))


@query("ag12_concentration", oracle(f"""
WITH p AS (SELECT {CELL} AS cell, pop, lat, lng, pixel FROM pixels), r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY pop DESC) AS k FROM p)
SELECT cell, count(*) AS n_px, round(sum(pop), 6) AS total, max(pop) AS largest, round(sum(pop) * sum(pop) / sum(pop * pop), 6) AS n_eff, round(sum(CASE WHEN k <= 3 THEN pop END) / sum(pop), 6) AS top3_share,
  round(sum(pop * lat) / sum(pop), 6) AS lat, round(sum(pop * lng) / sum(pop), 6) AS lng FROM r GROUP BY 1"""))
def concentration(spark, sf_dir):
    p = view(spark, sf_dir, "pixels").withColumn("cell", grid.cell_of("lat", "lng"))
    c = T.concentration(p, "cell", "pop", lat="lat", lng="lng")
    return c.select("cell", "n_px", F.round("total", 6).alias("total"), "largest", *[F.round(x, 6).alias(x) for x in ("n_eff", "top3_share", "lat", "lng")])


@query("ge17_implausible", oracle(f"""
WITH p AS (SELECT {CELL} AS cell, pop FROM pixels), r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY pop DESC) AS k FROM p)
SELECT cell, max(pop) > 400e0 OR (sum(pop) > 600e0 AND sum(CASE WHEN k <= 3 THEN pop END) / sum(pop) > 0.8e0) AS implausible FROM r GROUP BY 1"""))
def implausible(spark, sf_dir):
    from hexsite.config import Thresholds

    p = view(spark, sf_dir, "pixels").withColumn("cell", grid.cell_of("lat", "lng"))
    return T.concentration(p, "cell", "pop", lat="lat", lng="lng").select("cell", D.implausible(Thresholds(pixel_max=400.0, cell_pop=600.0)).alias("implausible"))


@query("ag13_mode_owner", oracle(f"""
WITH c AS (SELECT {CELL} AS cell, owner % 7 AS owner, count(*) AS c FROM pixels GROUP BY 1, 2)
SELECT cell, arg_min(owner, (-c, owner)) AS owner, max(c) AS n_mode, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY 1"""))
def mode_owner(spark, sf_dir):
    return T.mode(view(spark, sf_dir, "pixels").select(grid.cell_of("lat", "lng").alias("cell"), (F.col("owner") % 7).alias("owner")), "cell", "owner")


@query("wn6_normalised", oracle(f"WITH {POP}, q AS (SELECT pixel, {CELL} AS cell, pop FROM pixels) SELECT pixel, round(q.pop / cells.pop, 9) AS w FROM q JOIN cells USING (cell)"))
def normalised(spark, sf_dir):
    p = view(spark, sf_dir, "pixels").select("pixel", "pop", grid.cell_of("lat", "lng").alias("cell"))
    return p.join(p.groupBy("cell").agg(F.sum("pop").alias("t")), "cell").select("pixel", F.round(F.col("pop") / F.col("t"), 9).alias("w"))


# --- joins in space


@query("jn8_range_self_join", oracle(f"SELECT a.site_id AS a, b.site_id AS b, round({DIST}, 3) AS dist_m FROM sites a JOIN sites b ON a.site_id < b.site_id WHERE {DIST} <= 800e0"))
def range_self_join(spark, sf_dir):
    s = view(spark, sf_dir, "sites").select("site_id", "lat", "lng")
    return X.self_pairs(s, "site_id", 800.0).select(F.col("site_id").alias("a"), F.col("r_site_id").alias("b"), F.round("dist_m", 3).alias("dist_m"))


@query("jn10_exists_within", oracle(f"SELECT a.site_id, coalesce(min({DIST}) <= 300e0, false) AS within_300, coalesce(min({DIST}) <= 600e0, false) AS within_600, coalesce(min({DIST}) <= 900e0, false) AS within_900 FROM sites a, poi b GROUP BY 1"))
def exists_within(spark, sf_dir):
    return X.exists_within(view(spark, sf_dir, "sites").select("site_id", "lat", "lng"), "site_id", view(spark, sf_dir, "poi").select("poi", "lat", "lng"), [300.0, 600.0, 900.0])


@query("jn11_nearest", oracle(f"SELECT a.site_id, arg_min(b.poi, ({DIST}, b.poi)) AS nearest, round(min({DIST}), 3) AS dist_m FROM sites a, poi b GROUP BY 1"))
def nearest(spark, sf_dir):
    return X.nearest(view(spark, sf_dir, "sites"), "site_id", view(spark, sf_dir, "poi"), "poi", [1000.0, 4000.0, 16000.0, 200000.0]).withColumn("dist_m", F.round("dist_m", 3))


CENTROIDS = "WITH k AS (SELECT province, quantile_cont(lat, 0.5) AS lat, quantile_cont(lng, 0.5) AS lng FROM sites WHERE province IS NOT NULL GROUP BY 1)"


def _centroids(spark, sf_dir):
    return view(spark, sf_dir, "sites").filter("province IS NOT NULL").groupBy("province").agg(F.percentile("lat", 0.5).alias("lat"), F.percentile("lng", 0.5).alias("lng"))


@query("jn12_voronoi", oracle(CENTROIDS + f" SELECT a.site_id, arg_min(b.province, ({DIST}, b.province)) AS nearest, round(min({DIST}), 3) AS dist_m FROM sites a, k b GROUP BY 1"))
def voronoi(spark, sf_dir):
    return X.nearest_of_few(view(spark, sf_dir, "sites"), "site_id", _centroids(spark, sf_dir), "province").withColumn("dist_m", F.round("dist_m", 3))


@query("ms10_far_from_own", oracle(CENTROIDS + f""", n AS (SELECT a.site_id, arg_min(b.province, ({DIST}, b.province)) AS near, min({DIST}) AS dn FROM sites a, k b GROUP BY 1),
o AS (SELECT a.site_id, a.province, {DIST} AS own FROM sites a JOIN k b ON a.province = b.province)
SELECT site_id, own > 30000e0 AS far, own > 30000e0 AND near <> province AND own - dn > 20000e0 AS mismatch FROM o JOIN n USING (site_id)"""))
def far_from_own(spark, sf_dir):
    from hexsite.operators.coords import mismatch

    return mismatch(view(spark, sf_dir, "sites"), _centroids(spark, sf_dir), far_km=30.0, margin_km=20.0).select("site_id", "far", "mismatch")


BOX = "lat BETWEEN lat0 AND lat1 AND lng BETWEEN lng0 AND lng1"


@query("jn13_point_in_polygon", oracle(f"SELECT s.site_id, (SELECT min(p.province) FROM provinces p WHERE s.lat BETWEEN p.lat0 AND p.lat1 AND s.lng BETWEEN p.lng0 AND p.lng1) AS province FROM sites s"))
def point_in_polygon(spark, sf_dir):
    return X.in_boxes(view(spark, sf_dir, "sites").select("site_id", "lat", "lng"), "site_id", view(spark, sf_dir, "provinces"), "province")


def _supply_sql():
    from hexsite.plans.supply_queries import RESOLVED

    return RESOLVED


@query("ms15_sites_per_commune", oracle(_supply_sql() + "SELECT province, count(*) AS n FROM (SELECT (SELECT min(p.province) FROM provinces p WHERE s.lat BETWEEN p.lat0 AND p.lat1 AND s.lng BETWEEN p.lng0 AND p.lng1) AS province FROM x s WHERE in_supply) GROUP BY 1"))
def per_commune(spark, sf_dir):
    from hexsite.operators import supply as S
    from hexsite.plans.supply_queries import sites

    s = S.split_supply(sites(spark, sf_dir))[0].select("site_id", "lat", "lng")
    return X.in_boxes(s, "site_id", view(spark, sf_dir, "provinces"), "province").groupBy("province").agg(F.count(F.lit(1)).alias("n"))


DEG = "111320e0"


@query("jn14_nearest_polygon", oracle(f"""
WITH b AS (SELECT province, lat0 + 0.01e0 AS lat0, lat1 - 0.01e0 AS lat1, lng0 + 0.01e0 AS lng0, lng1 - 0.01e0 AS lng1 FROM provinces),
d AS (SELECT site_id, province, sqrt(pow(greatest(lat0 - lat, lat - lat1, 0e0), 2) + pow(greatest(lng0 - lng, lng - lng1, 0e0), 2)) * {DEG} AS d FROM sites, b1),
i AS (SELECT site_id, min(province) FILTER (d = 0) AS inside, arg_min(province, (d, province)) FILTER (d <= 500e0) AS near FROM d GROUP BY 1)
SELECT site_id, CASE WHEN inside IS NOT NULL THEN 'inside' WHEN near IS NOT NULL THEN 'nearest' ELSE 'none' END AS method, coalesce(inside, near) AS province FROM i""".replace("sites, b1", "(SELECT site_id, lat, lng FROM sites) s, b")))
def nearest_polygon(spark, sf_dir):
    b = view(spark, sf_dir, "provinces").select("province", (F.col("lat0") + 0.01).alias("lat0"), (F.col("lat1") - 0.01).alias("lat1"), (F.col("lng0") + 0.01).alias("lng0"), (F.col("lng1") - 0.01).alias("lng1"))
    return X.nearest_box(view(spark, sf_dir, "sites").select("site_id", "lat", "lng"), "site_id", b, "province", 500.0)


@query("jn7_spatial_match", oracle(f"""
WITH st AS (SELECT site_id, lat, lng, CASE site_id % 4 WHEN 0 THEN 'Trạm sạc ' || (site_id % 5) WHEN 1 THEN 'bãi xe' WHEN 2 THEN '' ELSE 'Điểm sạc' END AS name FROM sites),
re AS (SELECT store, lat, lng, CASE store % 3 WHEN 0 THEN 'tram sac ' || (store % 5) WHEN 1 THEN 'Bãi xe phía đông' ELSE 'kho' END AS name FROM registry),
c AS (SELECT a.site_id, b.store, {DIST} AS d,
  CASE WHEN a.site_id % 4 = 0 AND b.store % 3 = 0 THEN a.site_id % 5 = b.store % 5 WHEN a.site_id % 4 = 1 AND b.store % 3 = 1 THEN true ELSE false END AS alike FROM st a, re b WHERE {DIST} <= 250e0),
o AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY d, CAST(store AS VARCHAR)) AS k FROM c WHERE d <= 40e0 OR alike)
SELECT site_id, CAST(store AS VARCHAR) AS store, round(d, 3) AS dist_m FROM o WHERE k = 1"""))
def spatial_match(spark, sf_dir):
    """Names are alike where all words of one stand in the other; ``Trạm sạc 1`` and ``tram sac 2`` reach 90 of 100 by letters, so
    the threshold is set above that."""
    from hexsite.config import Thresholds
    from hexsite.operators import match as M

    i, j = F.col("site_id"), F.col("store")
    name = F.when(i % 4 == 0, F.concat(F.lit("Trạm sạc "), (i % 5).cast("string"))).when(i % 4 == 1, "bãi xe").when(i % 4 == 2, "").otherwise("Điểm sạc")
    s = view(spark, sf_dir, "sites").select(F.concat(F.lit("x"), i.cast("string")).alias("code"), name.alias("name"), "lat", "lng")
    r = view(spark, sf_dir, "registry").select(j.cast("string").alias("store"), F.when(j % 3 == 0, F.concat(F.lit("tram sac "), (j % 5).cast("string"))).when(j % 3 == 1, "Bãi xe phía đông").otherwise("kho").alias("name"), "lat", "lng")
    m = M.match(s, r, Thresholds(match_name=95.0)).filter("method = 'spatial_fuzzy'")
    return m.select(F.substring("code", 2, 20).cast("long").alias("site_id"), "store", F.round("dist_m", 3).alias("dist_m"))


@query("gr4_complexes", oracle(f"""
WITH /* recursive */ a AS (SELECT poi, lat, lng FROM poi WHERE class = 'APARTMENT'), e AS (SELECT a.poi AS x, b.poi AS y FROM a, a b WHERE a.poi <> b.poi AND {DIST} <= 1500e0),
w AS (SELECT poi AS x, poi AS y FROM a UNION SELECT w.x, e.y FROM w JOIN e ON w.y = e.x)
SELECT x AS poi, min(y) AS complex FROM w GROUP BY 1"""))
def complexes(spark, sf_dir):
    a = view(spark, sf_dir, "poi").filter("class = 'APARTMENT'").select("poi", "lat", "lng")
    e = X.self_pairs(a, "poi", 1500.0).select(F.col("poi").alias("a"), F.col("r_poi").alias("b"))
    return a.select("poi").join(components(e), F.col("poi") == F.col("node"), "left").select("poi", F.coalesce("component", "poi").alias("complex"))


@query("gr3_physical_merge", oracle(f"""
WITH /* recursive */ e AS (SELECT a.poi AS x, b.poi AS y FROM poi a, poi b WHERE a.class = b.class AND a.is_area <> b.is_area AND {DIST} <= 900e0),
w AS (SELECT poi AS x, poi AS y FROM poi UNION SELECT w.x, e.y FROM w JOIN e ON w.y = e.x),
g AS (SELECT x AS poi, min(y) AS grp FROM w GROUP BY 1)
SELECT g.poi, g.grp, g.poi = arg_min(p.poi, (NOT p.is_area, p.poi)) OVER (PARTITION BY g.grp) AS is_primary FROM g JOIN poi p ON p.poi = g.poi"""))
def physical_merge(spark, sf_dir):
    p = view(spark, sf_dir, "poi").select("poi", "class", "is_area", "lat", "lng")
    e = X.self_pairs(p, "poi", 900.0).filter((F.col("class") == F.col("r_class")) & (F.col("is_area") != F.col("r_is_area"))).select(F.col("poi").alias("a"), F.col("r_poi").alias("b"))
    g = p.join(components(e).hint("merge"), F.col("poi") == F.col("node"), "left").select("poi", "is_area", F.coalesce("component", "poi").alias("grp"))
    first = g.groupBy("grp").agg(F.min_by("poi", F.struct(~F.col("is_area"), "poi")).alias("first"))
    return g.join(first.hint("merge"), "grp").select("poi", "grp", (F.col("poi") == F.col("first")).alias("is_primary"))


# --- coverage and candidates

COVER = f"""
WITH {POP}, pts AS (SELECT cell, pop, {CLAT} AS clat, {CLNG} AS clng FROM cells),
cov AS (SELECT site_id, cell FROM (SELECT site_id, lat, lng FROM sites) s, pts WHERE {haversine_sql('lat', 'lng', 'clat', 'clng')} <= 3000e0)
"""


def _covered(spark, sf_dir, c=None):
    """Cells within the service radius of each site; the cells are built once."""
    return X.coverage(view(spark, sf_dir, "sites"), "site_id", cells(spark, sf_dir) if c is None else c, 3.0)


@query("jn29_coverage", oracle(COVER + "SELECT site_id, count(*) AS n, round(sum(pop), 6) AS pop FROM cov JOIN cells USING (cell) GROUP BY 1"))
def covered(spark, sf_dir):
    c = stored(cells(spark, sf_dir).select("cell", "pop"), "cells")
    return _covered(spark, sf_dir, c).join(c, "cell").groupBy("site_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pop"), 6).alias("pop"))


@query("q1_coverage_baseline", oracle(COVER + ", hit AS (SELECT sum(pop) AS c FROM cells WHERE cell IN (SELECT cell FROM cov)) SELECT round(coalesce(c, 0), 5) AS covered, round((SELECT sum(pop) FROM cells), 5) AS total, round(coalesce(c, 0) / (SELECT sum(pop) FROM cells), 6) AS share FROM hit"))
def coverage_baseline(spark, sf_dir):
    c = stored(cells(spark, sf_dir).select("cell", "pop"), "cells")
    u = P.union_coverage(_covered(spark, sf_dir, c), c, "pop")
    return u.select(F.round("covered", 5).alias("covered"), F.round("total", 5).alias("total"), F.round("share", 6).alias("share"))


@query("ag30_distinct_coverage", oracle(COVER + ", k AS (SELECT site_id, list(cell ORDER BY cell) AS l FROM cov GROUP BY 1) SELECT count(DISTINCT l) AS n_sets, count(*) AS n_candidates, round(count(DISTINCT l) * 1e0 / count(*), 6) AS ratio FROM k"))
def distinct_coverage(spark, sf_dir):
    return P.distinct_coverage(_covered(spark, sf_dir), "site_id").withColumn("ratio", F.round("ratio", 6))


def _greedy_sql(p: int) -> str:
    """The p steps one after the other: the largest gain, to six decimals, the least site on a tie; then its cells go."""
    steps, left = [], "g0"
    out = [", g0 AS (SELECT site_id, cell, pop FROM cov JOIN cells USING (cell))"]
    for k in range(p):
        out.append(f", b{k} AS (SELECT {k} AS step, site_id, sum(pop) AS gain FROM {left} GROUP BY site_id HAVING sum(pop) > 0 ORDER BY round(sum(pop), 6) DESC, site_id LIMIT 1), g{k + 1} AS (SELECT * FROM {left} WHERE cell NOT IN (SELECT cell FROM {left} WHERE site_id = (SELECT site_id FROM b{k})))")
        left = f"g{k + 1}"
        steps.append(f"SELECT CAST(step AS INT) AS step, site_id, round(gain, 5) AS gain FROM b{k}")
    return "".join(out) + " " + " UNION ALL ".join(steps)


@query("mclp_greedy", oracle(COVER + _greedy_sql(5)))
def greedy(spark, sf_dir):
    """Beyond a fixed catalogue: greedy maximal covering."""
    return P.greedy(_covered(spark, sf_dir), "site_id", cells(spark, sf_dir), "pop", 5).withColumn("gain", F.round("gain", 5))


ANCHORS = f"""
WITH k AS (
  SELECT {CELL} AS cell, 0 AS rank, 'T0' AS tier, site_id AS ref FROM sites WHERE coord_resolved
  UNION ALL SELECT {CELL}, 1, 'T1', poi FROM poi WHERE poi % 31 <> 0 AND poi % 7 <> 0 AND (class = 'FUEL' OR class = 'PARKING_OFF' AND access <> 'RESTRICTED')
  UNION ALL SELECT {CELL}, 2, 'T2', poi FROM poi WHERE poi % 31 <> 0 AND poi % 7 <> 0 AND class IN ('MALL', 'SUPERMARKET', 'MARKET', 'DEPT_STORE')
  UNION ALL SELECT {CELL}, 2, 'T2', poi FROM poi WHERE poi IN (SELECT min(poi) FROM poi WHERE poi % 31 <> 0 AND poi % 7 <> 0 AND class = 'APARTMENT' GROUP BY poi % 40)),
b AS (SELECT cell, arg_min(tier, (rank, ref)) AS tier, arg_min(ref, (rank, ref)) AS ref FROM k GROUP BY 1)
"""


def _anchors(spark, sf_dir):
    """Sites that are resolved, and points of interest as anchors: one object each, inside the country, one apartment a complex."""
    here = grid.cell_of("lat", "lng").alias("cell")
    k = F.col("poi")
    poi = view(spark, sf_dir, "poi").withColumns({"in_country": k % 31 != 0, "is_primary": k % 7 != 0, "complex": k % 40})
    t0 = view(spark, sf_dir, "sites").filter("coord_resolved").select(here, F.lit("T0").alias("tier"), F.col("site_id").alias("ref"))
    return t0.unionByName(P.poi_anchors(poi).select(here, "tier", F.col("poi").alias("ref")))


@query("flt14_poi_anchors", oracle("""
SELECT poi, CASE WHEN class IN ('FUEL', 'PARKING_OFF') THEN 'T1' ELSE 'T2' END AS tier FROM poi
WHERE poi % 31 <> 0 AND poi % 7 <> 0 AND NOT (class = 'PARKING_OFF' AND access = 'RESTRICTED')
  AND (class <> 'APARTMENT' OR poi IN (SELECT min(poi) FROM poi WHERE poi % 31 <> 0 AND poi % 7 <> 0 AND class = 'APARTMENT' GROUP BY poi % 40))"""))
def poi_anchors(spark, sf_dir):
    k = F.col("poi")
    poi = view(spark, sf_dir, "poi").withColumns({"in_country": k % 31 != 0, "is_primary": k % 7 != 0, "complex": k % 40})
    return P.poi_anchors(poi).select("poi", "tier")


@query("flt12_corroborated", oracle(f"WITH {POP} SELECT cell FROM cells WHERE NOT (pop > 1500e0 AND cell % 3 <> 0 AND cell % 5 <> 0)"))
def corroborated(spark, sf_dir):
    """Flagged cells stay where a main road (every third) or a point of interest (every fifth) confirms them."""
    c = F.col("cell")
    marked = cells(spark, sf_dir).withColumns({"flagged": F.col("pop") > 1500, "arterial_m": F.when(c % 3 == 0, 10.0).otherwise(0.0), "trips": F.when(c % 5 == 0, 1.0)})
    return P.corroborated_only(marked, "flagged", "arterial_m", "trips").select("cell")


@query("flt15_without_noise", oracle(f"WITH {POP} SELECT cell FROM cells WHERE cell % 4 <> 0 OR pop > 1000e0 OR cell % 6 = 0"))
def without_noise(spark, sf_dir):
    c = F.col("cell")
    base = cells(spark, sf_dir).select("cell", F.when(c % 4 != 0, c % 40).alias("commune"), F.when(F.col("pop") > 1000, F.col("pop")).alias("pop"), F.when(c % 6 == 0, 5.0).alias("road_access"))
    return D.without_noise(base).select("cell")


@query("wn1_best_tier", oracle(ANCHORS + "SELECT cell, tier, ref FROM b"))
def best_tier(spark, sf_dir):
    return P.best_per_cell(_anchors(spark, sf_dir))


@query("wn13_candidate_ids", oracle(ANCHORS + "SELECT cell, tier, 'C' || lpad(CAST(row_number() OVER (ORDER BY tier, cell) - 1 AS VARCHAR), 6, '0') AS candidate_id FROM b"))
def candidate_ids(spark, sf_dir):
    return P.numbered(P.best_per_cell(_anchors(spark, sf_dir)), ["tier", "cell"]).select("cell", "tier", "candidate_id")


@query("jn24_gap_fill", oracle(ANCHORS.replace("WITH k AS", f"WITH {POP}, k AS") + ", f AS (SELECT cell, pop FROM cells WHERE cell NOT IN (SELECT cell FROM b)) SELECT cell, round(pop, 6) AS score FROM f WHERE pop >= (SELECT quantile_cont(pop, 0.9) FROM f)"))
def gap_fill(spark, sf_dir):
    free = cells(spark, sf_dir).join(_anchors(spark, sf_dir).select("cell").distinct(), "cell", "left_anti")
    return T.above_quantile(free, "pop", 0.9).select("cell", F.round("pop", 6).alias("score"))


LAND = f"""
WITH {POP}, l AS (
  SELECT cell, pop, CAST(cell % 11 AS DOUBLE) / 20e0 AS frac_water, CAST(cell % 7 AS DOUBLE) / 20e0 AS frac_wetland, CAST(cell % 13 AS DOUBLE) / 13e0 AS frac_crop, CAST(cell % 17 AS DOUBLE) / 40e0 AS built,
    CAST(cell % 3 AS DOUBLE) * 100e0 AS road_access, CAST(cell % 2 AS DOUBLE) * 100e0 AS road_len, CAST(cell % 5 AS DOUBLE) * 50e0 AS road_bridge,
    CASE WHEN cell % 19 = 0 THEN NULL ELSE CAST(cell % 97 AS DOUBLE) * 1000e0 END AS substation_m,
    CASE cell % 4 WHEN 0 THEN 'DIRECT' WHEN 1 THEN 'ADJACENT' WHEN 2 THEN 'NEAR' ELSE 'ISOLATED' END AS access_tier FROM cells)
"""


def _land(spark, sf_dir):
    c = F.col("cell")
    d = lambda n: (c % n).cast("double")
    tier = F.element_at(F.array(*map(F.lit, ("DIRECT", "ADJACENT", "NEAR", "ISOLATED"))), (c % 4 + 1).cast("int"))
    return cells(spark, sf_dir).select("cell", "pop", (d(11) / 20).alias("frac_water"), (d(7) / 20).alias("frac_wetland"), (d(13) / 13).alias("frac_crop"), (d(17) / 40).alias("built"), (d(3) * 100).alias("road_access"), (d(2) * 100).alias("road_len"), (d(5) * 50).alias("road_bridge"), F.when(c % 19 != 0, d(97) * 1000).alias("substation_m"), tier.alias("access_tier"))


@query("ge13_penalty", oracle(LAND + """
SELECT cell, NOT (frac_water >= 0.5e0 OR frac_water + frac_wetland >= 0.7e0 OR built < 0.05e0 OR access_tier = 'ISOLATED' OR cell % 29 = 0 OR cell % 31 = 0) AS buildable,
  round_even(greatest(least(CASE WHEN frac_crop >= 0.6e0 THEN 0.3e0 ELSE 0e0 END + CASE WHEN built < 0.15e0 THEN 0.2e0 ELSE 0e0 END + CASE WHEN access_tier IN ('ADJACENT', 'NEAR') THEN 0.2e0 ELSE 0e0 END
    + CASE WHEN road_access > 0 AND road_len <= 0 THEN 0.1e0 ELSE 0e0 END + CASE WHEN road_access > 0 AND road_access - road_bridge <= 0 THEN 0.1e0 ELSE 0e0 END
    + coalesce(0.5e0 * least(substation_m / 50000e0, 1e0), 0.5e0), 1e0), 0e0), 3) AS penalty,
  concat_ws(';', CASE WHEN cell % 29 = 0 THEN 'AIRPORT' END, CASE WHEN cell % 31 = 0 THEN 'MILITARY' END, CASE WHEN built < 0.05e0 THEN 'NOT_BUILT_UP' END, CASE WHEN access_tier = 'ISOLATED' THEN 'ROAD_ACCESS_ISOLATED' END, CASE WHEN frac_water >= 0.5e0 THEN 'WATER' END, CASE WHEN frac_water + frac_wetland >= 0.7e0 THEN 'WETLAND' END) AS exclusion_flags,
  concat_ws(';', CASE WHEN frac_crop >= 0.6e0 THEN 'CROP' END, CASE WHEN built < 0.15e0 THEN 'LOW_BUILTUP' END, CASE WHEN access_tier IN ('ADJACENT', 'NEAR') THEN 'NEEDS_ACCESS_ROAD' END, CASE WHEN substation_m IS NULL THEN 'NO_SUBSTATION' END,
    CASE WHEN pop > 0 AND road_access <= 0 THEN 'POP_NO_ROAD' END, CASE WHEN road_access > 0 AND road_len <= 0 THEN 'ROAD_ACCESS_INFORMAL' END, CASE WHEN road_access > 0 AND road_access - road_bridge <= 0 THEN 'ROAD_BRIDGE_ONLY' END) AS penalty_flags
FROM l"""))
def penalty(spark, sf_dir):
    c = F.col("cell")
    zones = F.array_compact(F.array(F.when(c % 31 == 0, "MILITARY"), F.when(c % 29 == 0, "AIRPORT")))
    land = _land(spark, sf_dir).withColumn("zones", F.when(F.size(zones) > 0, zones))
    return P.feasibility(land, zones="zones").select("cell", "buildable", "penalty", F.array_join("exclusion_flags", ";").alias("exclusion_flags"), F.array_join("penalty_flags", ";").alias("penalty_flags"))


@query("jn22_assembled", oracle(ROADS.replace("cells AS (SELECT", "cells AS (SELECT") + """, a AS (SELECT DISTINCT @CELL@ AS cell FROM poi UNION SELECT DISTINCT @CELL@ FROM sites),
t AS (SELECT a.cell, CASE WHEN coalesce((SELECT sum(b.pop) FROM cells b WHERE b.cell = a.cell), 0) > 0 THEN 'DIRECT' WHEN (SELECT sum(b.pop) FROM cells b, s1 WHERE b.cell = a.cell + s1.s) > 0 THEN 'ADJACENT' WHEN (SELECT sum(b.pop) FROM cells b, s2 WHERE b.cell = a.cell + s2.s) > 0 THEN 'NEAR' ELSE 'ISOLATED' END AS tier,
  coalesce((SELECT sum(b.pop) FROM cells b WHERE b.cell = a.cell), 0) AS road FROM a)
SELECT cell, tier AS access_tier, round(road, 5) AS road_access, CASE WHEN cell % 7 = 0 THEN 0.9e0 ELSE 0e0 END AS frac_water, CASE WHEN cell % 13 = 0 THEN 'AIRPORT;MILITARY' END AS zones,
  NOT (cell % 7 = 0 OR tier = 'ISOLATED' OR cell % 13 = 0) AS buildable FROM t""".replace("@CELL@", CELL)))
def assembled(spark, sf_dir):
    """Cells of an area; the demand knows only some of them, the others' tiers and roads come from the road table."""
    here = grid.cell_of("lat", "lng").alias("cell")
    area_cells = view(spark, sf_dir, "poi").select(here).union(view(spark, sf_dir, "sites").select(here)).distinct()
    c = F.col("cell")
    roads = view(spark, sf_dir, "pixels").groupBy(here).agg(F.sum(F.when(F.col("pixel") % 3 == 0, F.col("pop")).otherwise(0.0)).alias("road_access")).withColumns({"road_len": F.col("road_access"), "road_bridge": F.lit(0.0)})
    known = area_cells.filter("cell % 2 = 0")
    demand = known.join(roads, "cell", "left").fillna(0.0).withColumn("pop", F.lit(1.0)).join(D.tiers_for(known, roads), "cell")
    land = area_cells.filter("cell % 3 <> 1 OR cell % 7 = 0").select("cell", F.when(c % 7 == 0, 0.9).otherwise(0.0).alias("frac_water"), F.lit(0.0).alias("frac_wetland"), F.lit(0.0).alias("frac_crop"))
    zones = area_cells.filter("cell % 13 = 0").withColumn("flags", F.array(F.lit("AIRPORT"), F.lit("MILITARY")))
    out = P.assembled(area_cells, land, demand, roads, zones, area_cells.withColumn("substation_m", F.lit(1000.0))).withColumn("built", F.lit(0.5))
    return P.feasibility(out, zones="zones").select("cell", "access_tier", F.round("road_access", 5).alias("road_access"), "frac_water", F.array_join("zones", ";").alias("zones"), "buildable")


MOVE = f"""
WITH {POP}, l AS (SELECT cell, pop, CASE WHEN cell % 23 = 0 THEN NULL ELSE cell % 50 END AS commune, cell % 4 <> 0 AS source, CASE WHEN cell % 4 = 0 AND cell % 50 < 44 THEN CAST(cell % 9 AS DOUBLE) ELSE 0e0 END AS built,
  CASE WHEN cell % 50 % 7 = 0 THEN 0e0 ELSE 1e4 END AS census, 1e4 + CAST(cell % 50 AS DOUBLE) * 500e0 AS estimate FROM cells),
s AS (SELECT commune, sum(CASE WHEN source THEN pop ELSE 0 END) AS removed, sum(CASE WHEN NOT source THEN built ELSE 0 END) AS total, max(census) AS census, max(estimate) AS estimate FROM l WHERE commune IS NOT NULL GROUP BY 1),
f AS (SELECT *, CASE WHEN census > 0 AND estimate > 1.5e0 * census THEN least(1e0, 0.859e0 / (estimate / census)) ELSE 1e0 END AS cut, coalesce(total > 0, false) AND coalesce(removed > 0, false) AS can FROM s)
"""


@query("ag20_reallocate", oracle(MOVE + """
SELECT cell, round(CASE WHEN source AND coalesce(can, false) THEN 0e0 ELSE pop END + CASE WHEN NOT source AND built > 0 AND coalesce(can, false) THEN removed * cut * built / total ELSE 0e0 END, 6) AS pop_new,
  CASE WHEN NOT source THEN 'WORLDPOP' WHEN l.commune IS NULL THEN 'UNREPAIRED_NO_COMMUNE' WHEN NOT coalesce(can, false) THEN 'UNREPAIRED_NO_ACCESSIBLE_BUILTUP' ELSE 'MOVED_TO_ACCESSIBLE' END AS pop_src
FROM l LEFT JOIN f ON l.commune = f.commune"""))
def reallocated(spark, sf_dir):
    c = F.col("cell")
    base = cells(spark, sf_dir).select(
        "cell", "pop", F.when(c % 23 != 0, c % 50).alias("commune"), (c % 4 != 0).alias("src"), F.when((c % 4 == 0) & (c % 50 < 44), (c % 9).cast("double")).otherwise(0.0).alias("built"),
        F.when(c % 50 % 7 == 0, 0.0).otherwise(1e4).alias("census"), (1e4 + (c % 50).cast("double") * 500).alias("estimate"),
    )
    return D.reallocate(base, source=F.col("src"), receiver=~F.col("src"), census="census", commune_pop="estimate").select("cell", F.round("pop_new", 6).alias("pop_new"), "pop_src")


@query("jn19_outer_merge", oracle(f"WITH {POP}, o AS (SELECT {CELL} AS cell, count(*) AS n_poi, sum(levels) AS levels FROM poi GROUP BY 1), s AS (SELECT {CELL} AS cell, count(*) AS n_site FROM sites GROUP BY 1) SELECT coalesce(cells.cell, o.cell, s.cell) AS cell, round(coalesce(pop, 0), 6) AS pop, coalesce(n_poi, 0) AS n_poi, coalesce(n_site, 0) AS n_site FROM cells FULL JOIN o ON cells.cell = o.cell FULL JOIN s ON s.cell = coalesce(cells.cell, o.cell)"))
def outer_merge(spark, sf_dir):
    at = lambda name, n: view(spark, sf_dir, name).groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.count(F.lit(1)).alias(n))
    return D.merge_layers(cells(spark, sf_dir).select("cell", "pop"), at("poi", "n_poi"), at("sites", "n_site")).withColumn("pop", F.round("pop", 6))


CLASSES = ("FUEL", "PARKING_OFF", "MALL", "DEPT_STORE", "SUPERMARKET", "MARKET", "APARTMENT")


@query("ag15_class_pivot", oracle(f"SELECT {CELL} AS cell, " + ", ".join(f"count_if(class = '{c}') AS n_{c.lower()}" for c in CLASSES) + ", count_if(access = 'RESTRICTED') AS n_restricted, sum(CASE WHEN class = 'APARTMENT' THEN levels END) AS levels FROM poi GROUP BY 1"))
def class_pivot(spark, sf_dir):
    return view(spark, sf_dir, "poi").groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(*[F.count_if(F.col("class") == c).alias(f"n_{c.lower()}") for c in CLASSES], F.count_if(F.col("access") == "RESTRICTED").alias("n_restricted"), F.sum(F.when(F.col("class") == "APARTMENT", F.col("levels"))).alias("levels"))


@query("ge11_trip_score", oracle("SELECT cell, n_mall + n_dept_store + n_supermarket + 0.5e0 * n_market + n_apartment AS trips FROM (SELECT " + CELL + " AS cell, " + ", ".join(f"count_if(class = '{c}') AS n_{c.lower()}" for c in CLASSES) + " FROM poi GROUP BY 1)"))
def trips(spark, sf_dir):
    return class_pivot(spark, sf_dir).select("cell", P.trip_score("n_mall", "n_dept_store", "n_supermarket", "n_market", "n_apartment").alias("trips"))

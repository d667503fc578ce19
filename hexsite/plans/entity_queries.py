"""Physical duplicates, seeds, histories, and layers that are put together."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.config import Thresholds
from hexsite.functions import grid
from hexsite.operators import demand as D
from hexsite.operators import match as M
from hexsite.operators import roads as R
from hexsite.operators import telemetry as T
from hexsite.plans.catalogue import query
from hexsite.plans.misc_queries import PARTS, _parts
from hexsite.plans.projections import oracle, tables, view
from hexsite.plans.spatial_queries import CELL, DIST, POP, cells
from hexsite.sources import readers


@query("gr1_physical_duplicates", oracle(f"""
WITH /* recursive */ st AS (SELECT CAST(site_id AS VARCHAR) AS id, site_id, lat, lng, CASE WHEN site_id % 40 < 2 THEN 'S' || (site_id - site_id % 40) WHEN site_id % 40 = 7 THEN 'T' || site_id END AS store, site_id % 2 AS kind FROM sites),
nr AS (SELECT a.id AS x, b.id AS y, a.kind = b.kind AND NOT coalesce(a.store <> b.store, false) AS alike FROM st a JOIN st b ON a.id < b.id WHERE {DIST} <= 400e0),
e1 AS (SELECT x, y FROM nr UNION ALL SELECT y, x FROM nr),
r1 AS (SELECT id AS x, id AS y FROM st UNION SELECT r1.x, e1.y FROM r1 JOIN e1 ON r1.y = e1.x),
bl AS (SELECT x AS id, count(*) >= 5 AS blob FROM r1 GROUP BY 1),
t2 AS (SELECT nr.x, nr.y FROM nr JOIN bl a ON a.id = nr.x JOIN bl b ON b.id = nr.y WHERE alike AND NOT a.blob AND NOT b.blob),
t1 AS (SELECT f.x, st.id AS y FROM st JOIN (SELECT store, min(id) AS x FROM st WHERE store IS NOT NULL GROUP BY 1) f ON st.store = f.store WHERE st.id <> f.x),
e2 AS (SELECT x, y FROM t1 UNION ALL SELECT y, x FROM t1 UNION ALL SELECT x, y FROM t2 UNION ALL SELECT y, x FROM t2),
r2 AS (SELECT id AS x, id AS y FROM st UNION SELECT r2.x, e2.y FROM r2 JOIN e2 ON r2.y = e2.x),
gp AS (SELECT x AS id, min(y) AS grp FROM r2 GROUP BY 1)
SELECT gp.id, grp, first_value(gp.id) OVER (PARTITION BY grp ORDER BY site_id % 5 = 0 DESC, site_id % 3 = 0 DESC, site_id % 10 DESC, site_id % 2 = 0 DESC, gp.id) AS survivor, blob
FROM gp JOIN st ON st.id = gp.id JOIN bl ON bl.id = gp.id"""))
def physical_duplicates(spark, sf_dir):
    """Sites of one store are one place; so are near ones of like names, unless they belong to a blob or have stores of their own."""
    i = F.col("site_id")
    text = i.cast("string")
    s = view(spark, sf_dir, "sites").select(
        text.alias("id"), F.when(i % 2 == 0, "trạm sạc Bến Thành").otherwise("bãi xe công viên").alias("name"), F.lit("").alias("address"), "lat", "lng",
        F.when(i % 40 < 2, F.concat(F.lit("S"), (i - i % 40).cast("string"))).when(i % 40 == 7, F.concat(F.lit("T"), text)).alias("store"), F.lit("own").alias("own_code"),
        (i % 5 == 0).alias("exact"), (i % 3 == 0).alias("matched"), (i % 10).cast("double").alias("confidence"), (i % 2 == 0).alias("has_series"),
    )
    return M.physical_duplicates(s, Thresholds(dup_radius_m=400.0)).select("id", F.col("group").alias("grp"), "survivor", "blob")


@query("src16_seeds", oracle("SELECT DISTINCT c_custkey % 700 AS code FROM customer WHERE c_nationkey % 3 <> 0 AND c_acctbal >= 0 AND c_custkey % 700 NOT IN (SELECT s_suppkey FROM supplier)"))
def seeds(spark, sf_dir):
    """Live stations with valid coordinates (here: a balance that isn't negative) that the catalogue lacks, once each."""
    t = tables(spark, sf_dir, "customer", "supplier")
    status = F.element_at(F.array(F.lit("CLOSED"), F.lit("ACTIVE"), F.lit("BUSY")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    stations = t["customer"].select((F.col("c_custkey") % 700).alias("code"), status.alias("status"), "c_acctbal")
    return readers.seeds(stations, t["supplier"].select(F.col("s_suppkey").alias("code")), "code", ["ACTIVE", "BUSY"], F.col("c_acctbal") >= 0).select("code")


@query("src17_history", oracle("""
SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE 2 END AS n, CASE WHEN event_id % 5 = 4 THEN NULL ELSE CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE 1 END END AS n_bad,
  CASE WHEN event_id % 5 = 4 THEN NULL ELSE event_id + 60 END AS last_ts FROM events"""))
def history(spark, sf_dir):
    """Points as pairs or as objects; what has no time is counted, and what is no list is nothing."""
    k = F.col("event_id").cast("string")
    later = (F.col("event_id") + 60).cast("string")
    pairs = F.concat(F.lit("[["), k, F.lit(",1],["), later, F.lit(",2]]"))
    objects = F.concat(F.lit('[{"timestamp":'), k, F.lit(',"value":"3"},{"timestamp":'), later, F.lit(',"value":4}]'))
    broken = F.concat(F.lit('[{"timestamp":'), k, F.lit('},["x",1],['), later, F.lit(",2]]"))
    m = F.col("event_id") % 5
    payload = F.when(m == 0, pairs).when(m == 1, objects).when(m < 4, broken).otherwise('{"error": 1}')
    h = tables(spark, sf_dir, "events")["events"].select("event_id", payload.alias("p")).withColumn("h", T.parse_history("p"))
    points = F.col("h.points")
    return h.select("event_id", F.when(points.isNotNull(), F.size(points)).alias("n"), "h.n_bad", F.element_at(points, -1)["ts"].alias("last_ts"))


@query("jn20_union_grid", oracle(f"WITH {POP}, k AS (SELECT cell FROM cells UNION SELECT {CELL} FROM poi), p AS (SELECT {CELL} AS cell, count(*) AS n_poi FROM poi GROUP BY 1) SELECT k.cell, round(pop, 6) AS pop, n_poi FROM k LEFT JOIN cells USING (cell) LEFT JOIN p USING (cell)"))
def union_grid(spark, sf_dir):
    """All cells that either side knows, with what each says; what one doesn't know stays null."""
    poi = view(spark, sf_dir, "poi").groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.count(F.lit(1)).alias("n_poi"))
    c = cells(spark, sf_dir).select("cell", F.round("pop", 6).alias("pop"))
    keys = c.select("cell").union(poi.select("cell")).distinct()
    return keys.join(c, "cell", "left").join(poi, "cell", "left")


@query("jn21_poi_and_roads", oracle(f"""
WITH {PARTS}, r AS (SELECT cell, sum(metres) AS road_access_m, sum(CASE WHEN tier NOT IN ('SERVICE', 'TRACK') THEN metres ELSE 0 END) AS road_len_m FROM u GROUP BY 1),
o AS (SELECT {CELL} AS cell, count_if(class = 'FUEL') AS n_fuel, count_if(class = 'PARKING_OFF') - count_if(class = 'PARKING_OFF' AND access = 'RESTRICTED') AS n_parking FROM poi GROUP BY 1)
SELECT coalesce(r.cell, o.cell) AS cell, coalesce(n_fuel, 0) AS n_fuel, coalesce(n_parking, 0) AS n_parking, round(coalesce(road_access_m, 0), 3) AS road_access_m, round(coalesce(road_len_m, 0), 3) AS road_len_m FROM r FULL JOIN o ON r.cell = o.cell"""))
def poi_and_roads(spark, sf_dir):
    """Layers of points and of roads; a cell that one of them lacks has 0. Parking is less what is restricted."""
    parking = F.col("class") == "PARKING_OFF"
    poi = view(spark, sf_dir, "poi").groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.count_if(F.col("class") == "FUEL").alias("n_fuel"), (F.count_if(parking) - F.count_if(parking & (F.col("access") == "RESTRICTED"))).alias("n_parking"))
    roads = R.road_policy(R.road_layers(_parts(spark, sf_dir))).select("cell", "road_access_m", "road_len_m")
    return D.merge_layers(poi, roads).select("cell", "n_fuel", "n_parking", F.round("road_access_m", 3).alias("road_access_m"), F.round("road_len_m", 3).alias("road_len_m"))

"""Roads, areas, text, JSON, tariff, gates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.functions import columns as K
from hexsite.functions import grid
from hexsite.operators import admin as A
from hexsite.operators import connectors as C
from hexsite.operators import gates as G
from hexsite.operators import match as M
from hexsite.operators import roads as R
from hexsite.operators import tariff as E
from hexsite.plans.catalogue import query
from hexsite.plans.projections import oracle, tables, view
from hexsite.plans.spatial_queries import CELL, CLAT, CLNG, DIST, POP, cells
from hexsite.plans.supply_queries import RESOLVED, sites

# --- roads: orders as polylines of their lines

NODES = """
SELECT l_orderkey AS way, l_linenumber AS k, 20.6e0 + CAST((l_orderkey * 6151) % 9973 AS DOUBLE) / 9973e0 * 0.9e0 + CAST(l_linenumber * (l_partkey % 7) AS DOUBLE) * 0.0007e0 AS lat,
  105.4e0 + CAST((l_orderkey * 3571) % 9967 AS DOUBLE) / 9967e0 * 0.9e0 + CAST(l_linenumber * (l_partkey % 5) AS DOUBLE) * 0.0009e0 AS lng,
  CASE l_orderkey % 5 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk_link' WHEN 2 THEN 'residential' WHEN 3 THEN 'service' ELSE 'busway' END AS highway, l_orderkey % 3 = 0 AS bridge, l_orderkey % 2 = 0 AS tagged
FROM lineitem"""
PARTS = f"""
n AS ({NODES}), p AS (SELECT *, lead(lat) OVER w AS la, lead(lng) OVER w AS lo FROM n WINDOW w AS (PARTITION BY way ORDER BY k, lat, lng)),
s AS (SELECT *, {DIST.replace('a.lat', 'lat').replace('a.lng', 'lng').replace('b.lat', 'la').replace('b.lng', 'lo')} AS m FROM p WHERE la IS NOT NULL),
c AS (SELECT *, greatest(1, CAST(floor(m / 150e0) AS INT)) AS parts FROM s),
e AS (SELECT *, unnest(range(0, parts)) AS i FROM c),
q AS (SELECT way, highway, bridge, tagged, lat + (i + 0.5e0) / parts * (la - lat) AS lat, lng + (i + 0.5e0) / parts * (lo - lng) AS lng, m / parts AS metres FROM e),
g AS (SELECT way, highway, bridge, tagged, {CELL} AS cell, metres FROM q),
t AS (SELECT *, CASE highway WHEN 'motorway' THEN 'MOTORWAY' WHEN 'trunk_link' THEN 'TRUNK' WHEN 'residential' THEN 'LOCAL' WHEN 'service' THEN 'SERVICE' ELSE 'OTHER' END AS tier FROM g),
u AS (SELECT *, CASE WHEN tagged THEN 3e0 WHEN tier = 'SERVICE' THEN 1e0 ELSE 2e0 END AS lanes FROM t)
"""


def _parts(spark, sf_dir):
    text = NODES.replace("FROM lineitem", "FROM {lineitem}")
    nodes = spark.sql(text, **tables(spark, sf_dir, "lineitem"))
    ways = nodes.groupBy("way").agg(F.first("highway").alias("highway"), F.first("bridge").alias("bridge"), F.first("tagged").alias("tagged"))
    tier = R.tier_of(F.col("highway"))
    lanes, seen = R.lanes_of(F.col("tier"), F.when(F.col("tagged"), "3;4"), F.lit("no"))
    return R.segments(nodes, "way", ["k", "lat", "lng"]).join(ways, "way").withColumn("tier", tier).withColumn("lanes", lanes).withColumn("observed", seen)


@query("ge9_segments", oracle(f"WITH {PARTS} SELECT cell, count(*) AS n, round(sum(metres), 3) AS metres FROM g GROUP BY 1"))
def segments(spark, sf_dir):
    return _parts(spark, sf_dir).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("metres"), 3).alias("metres"))


@query("ag16_road_layers", oracle(f"WITH {PARTS} SELECT cell, round(sum(CASE WHEN tier NOT IN ('SERVICE', 'TRACK') THEN metres ELSE 0 END), 3) AS road_len_m, round(sum(metres), 3) AS road_access_m, round(sum(CASE WHEN tier = 'MOTORWAY' THEN metres * lanes ELSE 0 END), 3) AS road_lane_mw_m, round(sum(CASE WHEN tier IN ('TRUNK', 'PRIMARY') THEN metres * lanes ELSE 0 END), 3) AS road_lane_ar_m, round(sum(CASE WHEN bridge THEN metres ELSE 0 END), 3) AS road_bridge_m FROM u GROUP BY 1"))
def road_layers(spark, sf_dir):
    p = R.road_policy(R.road_layers(_parts(spark, sf_dir)))
    return p.select("cell", *[F.round(c, 3).alias(c) for c in p.columns[1:]])


@query("ms17_observed_share", oracle(f"WITH {PARTS} SELECT round(sum(CASE WHEN tagged THEN metres * lanes ELSE 0 END) / sum(metres * lanes), 6) AS share FROM u WHERE tier IN ('MOTORWAY', 'TRUNK', 'PRIMARY')"))
def observed(spark, sf_dir):
    return R.observed_share(R.road_layers(_parts(spark, sf_dir))).select(F.round("share", 6).alias("share"))


GROUPS = ["water", "built", "crop", "tree"]


@query("ag14_cover_fractions", oracle(f"WITH c AS (SELECT {CELL} AS cell, CASE pixel % 4 WHEN 0 THEN 'water' WHEN 1 THEN 'built' WHEN 2 THEN 'crop' ELSE 'tree' END AS g FROM pixels) SELECT cell, count(*) AS n_px, " + ", ".join(f"round(count_if(g = '{g}') * 1e0 / count(*), 9) AS frac_{g}" for g in GROUPS) + " FROM c GROUP BY 1"))
def fractions(spark, sf_dir):
    p = view(spark, sf_dir, "pixels").select(grid.cell_of("lat", "lng").alias("cell"), F.element_at(F.array(*map(F.lit, GROUPS)), (F.col("pixel") % 4 + 1).cast("int")).alias("grp"))
    return R.cover_fractions(p, GROUPS).select("cell", "n_px", *[F.round(f"frac_{g}", 9).alias(f"frac_{g}") for g in GROUPS])


# --- areas


def _polygons(spark, sf_dir):
    """The provinces' boxes as WKB, built from their numbers in place."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            t = b.to_pydict()
            geoms = [A.wkb([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]) for x0, y0, x1, y1 in zip(t["lng0"], t["lat0"], t["lng1"], t["lat1"], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(geoms, pa.binary())], names=["province", "geom"])

    return view(spark, sf_dir, "provinces").select("province", "lat0", "lat1", "lng0", "lng1").mapInArrow(run, "province int, geom binary")


@query("jn17_points_in_wkb", oracle("SELECT s.site_id, (SELECT min(p.province) FROM provinces p WHERE s.lat > p.lat0 AND s.lat < p.lat1 AND s.lng > p.lng0 AND s.lng < p.lng1) AS province FROM sites s"))
def points_in_wkb(spark, sf_dir):
    """A site on an edge is in no province."""
    return A.points_in_polygons(view(spark, sf_dir, "sites").select("site_id", "lat", "lng"), "site_id", _polygons(spark, sf_dir), "province")


# A hexagon's share of a box, by integrating over latitude the width that both have: between the corners, the box's edges and the
# places where a side crosses an edge the width is linear, so trapezoids are exact. Half height and half width are of cells
# whose centres are 0.98 km apart on a grid with its standard parallel at 16 degrees.
HALF_LAT, HALF_LNG = "(0.98e0 / sqrt(3e0) / (6371.0088e0 * pi() / 180e0))", "(0.49e0 / (6371.0088e0 * pi() / 180e0 * cos(radians(16e0))))"


def _shares(where: str = "true") -> str:
    """SQL: sh(cell, province, area_share) of cells and the provinces' boxes."""
    width = "CASE WHEN abs(@ - cy) <= hh / 2 THEN hw ELSE hw * greatest(0e0, hh - abs(@ - cy)) / (hh / 2) END"
    both = f"greatest(0e0, least(cx + {width}, lng1) - greatest(cx - {width}, lng0))"
    cross = ", ".join(f"CASE WHEN {d} > 0 AND {d} < hw THEN cy {sign} (hh - {d} * (hh / 2) / hw) END" for d in ("(lng1 - cx)", "(lng0 - cx)", "(cx - lng0)", "(cx - lng1)") for sign in ("+", "-"))
    f = lambda y: both.replace("@", y)
    return f"""
    hx AS (SELECT cell, pop, {CLAT} AS cy, {CLNG} AS cx, {HALF_LAT} AS hh, {HALF_LNG} AS hw FROM cells),
    mt AS (SELECT *, greatest(lat0, cy - hh) AS lo, least(lat1, cy + hh) AS hi FROM hx JOIN provinces ON lat0 < cy + hh AND lat1 > cy - hh AND lng0 < cx + hw AND lng1 > cx - hw AND {where}),
    br AS (SELECT *, list_sort(list_distinct(list_filter([lo, hi, cy - hh / 2, cy + hh / 2, {cross}], lambda y: y IS NOT NULL AND y >= lo AND y <= hi))) AS ys FROM mt),
    tr AS (SELECT cell, pop, province, cx, cy, hh, hw, lat0, lat1, lng0, lng1, ys, unnest(range(1, len(ys))) AS i FROM br),
    sl AS (SELECT cell, pop, province, hh, hw, ys[i] AS y0, ys[i + 1] AS y1, {f("ys[i]")} AS f0, {f("ys[i + 1]")} AS f1 FROM tr),
    sh AS (SELECT cell, any_value(pop) AS pop, province, sum((f0 + f1) / 2 * (y1 - y0)) / any_value(3 * hh * hw) AS area_share FROM sl GROUP BY cell, province HAVING sum((f0 + f1) / 2 * (y1 - y0)) / any_value(3 * hh * hw) > 1e-9),
    wt AS (SELECT *, area_share / sum(area_share) OVER (PARTITION BY cell) AS w FROM sh)"""


@query("jn15_hex_overlap", oracle(f"WITH {POP}, {_shares()} SELECT cell, province, round(area_share, 6) AS area_share, round(w, 6) AS w FROM wt"))
def hex_overlap(spark, sf_dir):
    o = A.cell_overlaps(cells(spark, sf_dir), _polygons(spark, sf_dir), "province")
    return o.select("cell", "province", F.round("area_share", 6).alias("area_share"), F.round("w", 6).alias("w"))


@query("ag17_weighted_rollup", oracle(f"WITH {POP}, {_shares()}, t AS (SELECT province, sum(pop * w) AS pop, count(DISTINCT cell) AS n_cells, sum(w) AS w FROM wt GROUP BY 1) SELECT p.province, round(coalesce(pop, 0), 3) AS pop, coalesce(n_cells, 0) AS n_cells, round(coalesce(w, 0), 4) AS w FROM provinces p LEFT JOIN t ON p.province = t.province"))
def weighted_rollup(spark, sf_dir):
    c = cells(spark, sf_dir)
    polygons = _polygons(spark, sf_dir)
    out = A.weighted_rollup(A.cell_overlaps(c, polygons, "province"), c, "province", ["pop"], polygons)
    return out.select("province", F.round("pop", 3).alias("pop"), "n_cells", F.round("w", 4).alias("w"))


@query("wn8_argmax_label", oracle(f"WITH {POP}, {_shares()} SELECT cell, arg_min(province, (-round(area_share, 9), province)) AS province, count(*) AS n_overlaps FROM sh GROUP BY 1"))
def argmax_label(spark, sf_dir):
    return A.labels(A.cell_overlaps(cells(spark, sf_dir), _polygons(spark, sf_dir), "province"), "province")


@query("jn16_cell_vs_territory", oracle(f"WITH {POP}, {_shares('province < 10')}, t AS (SELECT cell, sum(area_share) AS share FROM sh GROUP BY 1) SELECT cells.cell, round(coalesce(share, 0), 6) AS share, CASE WHEN share IS NULL THEN 'OUTSIDE' WHEN share >= 1 - 1e-6 THEN 'INSIDE' ELSE 'BORDER' END AS state FROM cells LEFT JOIN t USING (cell)"))
def cell_vs_territory(spark, sf_dir):
    """INSIDE, BORDER with its share, or OUTSIDE."""
    west = _polygons(spark, sf_dir).filter("province < 10")
    o = A.cell_overlaps(cells(spark, sf_dir), west, "province").groupBy("cell").agg(F.sum("area_share").alias("share"))
    out = cells(spark, sf_dir).select("cell").join(o, "cell", "left")
    state = F.when(F.col("share").isNull(), "OUTSIDE").when(F.col("share") >= 1 - 1e-6, "INSIDE").otherwise("BORDER")
    return out.select("cell", F.round(F.coalesce("share", F.lit(0.0)), 6).alias("share"), state.alias("state"))


@query("ag18_dissolve", oracle("SELECT CAST(province % 5 AS INT) AS grp, count(*) AS n, round(sum((lat1 - lat0) * (lng1 - lng0)), 9) AS area, round(min(lat0), 9) AS lat0, round(max(lat1), 9) AS lat1, round(min(lng0), 9) AS lng0, round(max(lng1), 9) AS lng1, 1 AS parts, 5 AS corners FROM provinces GROUP BY 1"))
def dissolve(spark, sf_dir):
    """Bands of five boxes each become one box: five points, closed, and the inner edges are gone."""
    p = _polygons(spark, sf_dir).withColumn("grp", (F.col("province") % 5).cast("int"))
    union = A.with_boxes(A.dissolve(p, "grp"), "grp")

    @F.pandas_udf("struct<parts:int,corners:int,area:double>")
    def shape(raw):
        import pandas as pd

        out = []
        for r in raw:
            polygons = A.read_wkb(r)
            corner = lambda a, b, c: abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 1e-12
            ring = polygons[0][0][:-1]
            turns = sum(corner(ring[k - 1], ring[k], ring[(k + 1) % len(ring)]) for k in range(len(ring)))
            out.append((len(polygons), turns + 1, sum(A.area(x[0]) for x in polygons)))
        return pd.DataFrame(out, columns=["parts", "corners", "area"])

    n = p.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    s = union.withColumn("s", shape("geom")).join(n, F.col("name") == F.col("grp"))
    return s.select("grp", "n", F.round("s.area", 9).alias("area"), *[F.round(c, 9).alias(c) for c in ("lat0", "lat1", "lng0", "lng1")], "s.parts", "s.corners")


# --- text and JSON


@query("st3_plain_text", oracle("SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D'))), '[^a-z0-9]+', ' ', 'g'))) AS plain FROM documents WHERE text IS NOT NULL"))
def plain(spark, sf_dir):
    return tables(spark, sf_dir, "documents")["documents"].filter("text IS NOT NULL").select("doc_id", F.md5(K.plain_text(F.col("text")).cast("binary")).alias("plain"))


UNIT = ["Phường", "Xã", "Đặc khu", "Thị trấn", "Quận", "Huyện", "Thành phố", "Tỉnh", "TP", "Thị xã", ""]


@query("st4_bare_name", oracle("""
SELECT n_nationkey AS k, CASE WHEN n_nationkey % 11 = 9 THEN 'thi xa ' WHEN n_nationkey % 11 = 10 THEN '' ELSE '' END || replace(lower(n_name), '_', ' ') AS bare FROM nation"""))
def bare_names(spark, sf_dir):
    """Nine prefixes go; ``Thị xã`` isn't one of them, and only the first goes."""
    n = tables(spark, sf_dir, "nation")["nation"]
    name = F.concat(F.element_at(F.array(*map(F.lit, UNIT)), (F.col("n_nationkey") % 11 + 1).cast("int")), F.lit(" "), "n_name")
    return n.select(F.col("n_nationkey").alias("k"), K.bare_name(name).alias("bare"))


@query("st5_identity", oracle("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'tram sac ' || lower(c_mktsegment) || ' x' ELSE 'tram sac ' || lower(c_mktsegment) || ' ' || 'so ' || c_custkey || ' x' END AS who FROM customer"))
def identities(spark, sf_dir):
    """The address goes where it stands in the name, if it is long enough: a short one stays."""
    c = tables(spark, sf_dir, "customer")["customer"]
    short = F.concat(F.lit("Số "), F.col("c_custkey").cast("string"))
    address = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Đường Lê Lợi "), F.col("c_custkey").cast("string"))).otherwise(short)
    name = F.concat(F.lit("Trạm sạc "), "c_mktsegment", F.lit(" "), address, F.lit(" x"))
    least = F.when(F.col("c_custkey") % 2 == 0, address).otherwise(F.lit("Số"))
    return c.select(F.col("c_custkey").alias("k"), K.identity(name, least).alias("who"))


WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"


@query("st6_same_identity", oracle(f"""
WITH w AS (SELECT p_partkey AS k, {WORDS.format("trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'))")} AS a, {WORDS.format("trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', ' ', 'g'))")} AS b FROM part),
s AS (SELECT *, list_sort(list_filter(a, lambda x: regexp_matches(x, '\\d'))) AS sa, list_sort(list_filter(b, lambda x: regexp_matches(x, '\\d'))) AS sb FROM w)
SELECT k, (list_has_all(b, a) OR list_has_all(a, b)) AND (len(sa) = 0 OR len(sb) = 0 OR sa = sb) AND least(len(a), len(b)) >= 2 AS same FROM s"""))
def same(spark, sf_dir):
    p = tables(spark, sf_dir, "part")["part"]
    return p.select(F.col("p_partkey").alias("k"), K.same_identity(K.plain_text(F.col("p_name")), K.plain_text(F.concat("p_brand", F.lit(" "), "p_name"))).alias("same"))


@query("st7_token_set_ratio")
def similarity(spark, sf_dir):
    """Similarity of part names and brands; held against a table of edit distances in the tests."""
    from hexsite.functions.similarity import name_similarity

    p = tables(spark, sf_dir, "part")["part"]
    return p.select("p_partkey", F.round(name_similarity(F.lower("p_name"), F.lower(F.concat("p_type", F.lit(" "), "p_name"))), 6).alias("sim"))


@query("st13_number_in_list", oracle("SELECT p_partkey AS k, CASE WHEN p_size BETWEEN 1 AND 12 THEN CAST(p_size AS DOUBLE) END AS lanes, CASE WHEN p_size BETWEEN 1 AND 100 THEN CAST(p_size AS DOUBLE) END AS levels FROM part"))
def numbers(spark, sf_dir):
    p = tables(spark, sf_dir, "part")["part"].select(F.col("p_partkey").alias("k"), F.concat(F.col("p_size").cast("string"), F.lit(";junk")).alias("t"))
    return p.select("k", K.number_in(F.col("t"), 1, 12).alias("lanes"), R.levels_of(F.col("t")).alias("levels"))


GROUPED = """
WITH g AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
x AS (SELECT event_id, unnest([{'i': 0, 'w': k * 1000, 'n': 2}, {'i': 1, 'w': 0, 'n': 0}, {'i': 2, 'w': 60000, 'n': k % 3}]) AS s FROM g)
"""


@query("json_explode_groups", oracle(GROUPED + """, f AS (SELECT event_id, s.i AS i, s.w AS w, s.n AS n FROM x WHERE s.w > 0 OR s.n > 0)
SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS INT) AS idx, w / 1000e0 AS kw, CAST(n AS BIGINT) AS n, CASE WHEN w > 0 AND w <= 25000 THEN 'AC' ELSE 'DC' END AS current_type FROM f"""))
def groups(spark, sf_dir):
    e = tables(spark, sf_dir, "events")["events"]
    k = F.get_json_object("props", "$.k").cast("bigint")
    payload = F.concat(F.lit('[{"type":'), (k * 1000).cast("string"), F.lit(',"totalEvse":2},{"type":0,"totalEvse":0},{"type":"x","totalEvse":9},{"type":60000,"totalEvse":'), (k % 3).cast("string"), F.lit("}]"))
    return C.explode_groups(e.select("event_id", payload.alias("p")), "event_id", "p").select("event_id", "idx", "kw", "n", "current_type")


# --- matching


@query("c4_match_confidence", oracle(f"""
WITH s AS (SELECT CASE WHEN site_id % 9 = 0 THEN CAST(site_id AS VARCHAR) ELSE 'x' || site_id END AS code, site_id, lat, lng, CASE site_id % 3 WHEN 0 THEN 'Bến xe' WHEN 1 THEN NULL ELSE 'kho' END AS name FROM sites),
r AS (SELECT store, lat, lng, CASE store % 2 WHEN 0 THEN 'ben xe' ELSE 'chợ' END AS name FROM registry),
x AS (SELECT s.code, r.store, {DIST.replace('a.', 's.').replace('b.', 'r.')} AS d FROM s JOIN r ON s.code = CAST(r.store AS VARCHAR)),
c AS (SELECT a.code, b.store, {DIST} AS d, coalesce(a.name = 'Bến xe' AND b.name = 'ben xe', false) AS alike FROM s a, r b WHERE a.code NOT IN (SELECT code FROM x) AND {DIST} <= 250e0),
n AS (SELECT code, arg_min(store, (d, CAST(store AS VARCHAR))) AS store, min(d) AS d FROM c WHERE d <= 40e0 OR alike GROUP BY 1)
SELECT s.code, coalesce(CAST(x.store AS VARCHAR), CAST(n.store AS VARCHAR)) AS store, CASE WHEN x.code IS NOT NULL THEN 'exact_code' WHEN n.code IS NOT NULL THEN 'spatial_fuzzy' ELSE 'none' END AS method, round(coalesce(x.d, n.d), 3) AS dist_m
FROM s LEFT JOIN x ON s.code = x.code LEFT JOIN n ON s.code = n.code"""))
def matched(spark, sf_dir):
    """A row for each site: every ninth one is coded by its whole number, so no two sites share a code."""
    i = F.col("site_id")
    name = F.when(i % 3 == 0, "Bến xe").when(i % 3 == 2, "kho")
    s = view(spark, sf_dir, "sites").select(F.when(i % 9 == 0, i.cast("string")).otherwise(F.concat(F.lit("x"), i.cast("string"))).alias("code"), name.alias("name"), "lat", "lng")
    r = view(spark, sf_dir, "registry").select(F.col("store").cast("string").alias("store"), F.when(F.col("store") % 2 == 0, "ben xe").otherwise("chợ").alias("name"), "lat", "lng")
    return M.match(s, r).select("code", "store", "method", F.round("dist_m", 3).alias("dist_m"))


# --- tariff

MATRIX = """
WITH m AS (SELECT * FROM (VALUES ('tren_1kv', 'binh_thuong', 118e0), ('tren_1kv', 'thap_diem', 71e0), ('tren_1kv', 'cao_diem', 174e0), ('den_1kv', 'binh_thuong', 125e0), ('den_1kv', 'thap_diem', 75e0), ('den_1kv', 'cao_diem', 195e0)) t(voltage_group, band, percent)),
p AS (SELECT *, round_even(2204.07e0 * percent / 100e0, 2) AS price FROM m)
"""


@query("ge19_tariff", oracle(MATRIX + "SELECT voltage_group, band, price FROM p"))
def tariff(spark, sf_dir):
    return E.matrix(spark).select("voltage_group", "band", "price")


@query("ge19_blended", oracle(MATRIX + "SELECT voltage_group, round_even(sum(price * CASE band WHEN 'binh_thuong' THEN 96e0 WHEN 'thap_diem' THEN 42e0 ELSE 30e0 END / 168e0), 2) AS blended FROM p GROUP BY 1"))
def blended(spark, sf_dir):
    return E.blended(E.matrix(spark), E.clock_shares())


@query("tou_bands", oracle("""
SELECT event_id, CASE WHEN ((hour(ts) * 60 + minute(ts) BETWEEN 570 AND 689) OR (hour(ts) * 60 + minute(ts) BETWEEN 1020 AND 1199)) AND dayofweek(ts) <> 0 THEN 'cao_diem'
  WHEN hour(ts) >= 22 OR hour(ts) < 4 THEN 'thap_diem' ELSE 'binh_thuong' END AS band FROM events"""))
def bands(spark, sf_dir):
    return tables(spark, sf_dir, "events")["events"].select("event_id", E.band_of(F.col("ts")).alias("band"))


# --- gates, sets, integrity


@query("gates_supply", oracle(RESOLVED + """
SELECT 'pk_unique' AS gate, CASE WHEN count(*) = count(DISTINCT site_id) THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) - count(DISTINCT site_id) AS DOUBLE) AS value, 0e0 AS "limit" FROM x
UNION ALL SELECT 'one_reason', CASE WHEN count_if(NOT in_supply AND reason IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count_if(NOT in_supply AND reason IS NULL) AS DOUBLE), 0e0 FROM x
UNION ALL SELECT 'resolved_rate', CASE WHEN avg(CASE WHEN coord_resolved THEN 1e0 ELSE 0e0 END) >= 0.985e0 THEN 'PASS' ELSE 'FAIL' END, round(avg(CASE WHEN coord_resolved THEN 1e0 ELSE 0e0 END), 9), 0.985e0 FROM x
UNION ALL SELECT 'in_box', CASE WHEN count_if(lat > 21.4e0) = 0 THEN 'PASS' ELSE 'WARN' END, CAST(count_if(lat > 21.4e0) AS DOUBLE), 0e0 FROM x"""))
def gates(spark, sf_dir):
    from hexsite.operators import supply as S

    df = sites(spark, sf_dir).withColumn("in_supply", S.supply_mask()).withColumn("reason", S.exclusion_reason())
    checks = [
        G.unique("pk_unique", "site_id"),
        G.none_where("one_reason", ~F.col("in_supply") & F.col("reason").isNull()),
        G.share_of("resolved_rate", F.col("coord_resolved"), 0.985),
        G.none_where("in_box", F.col("lat") > 21.4, warn=True),
    ]
    return G.evaluate(df, checks).withColumn("value", F.round("value", 9))


@query("jn28_orphans", oracle("SELECT DISTINCT l_orderkey % 20000 AS station FROM lineitem WHERE l_orderkey % 20000 NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0)"))
def orphans(spark, sf_dir):
    t = tables(spark, sf_dir, "lineitem", "orders")
    child = t["lineitem"].select((F.col("l_orderkey") % 20000).alias("station"))
    return G.orphans(child, t["orders"].filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("station")), "station")


@query("se3_set_gates", oracle(RESOLVED + """, e AS (SELECT * FROM x WHERE NOT in_supply), u AS (SELECT * FROM x WHERE in_supply), p AS (SELECT site_id FROM x WHERE in_supply AND NOT dirty)
SELECT 'reconcile' AS gate, CAST((SELECT count(*) FROM x) - (SELECT count(*) FROM u) - (SELECT count(*) FROM e) AS DOUBLE) AS value, CASE WHEN (SELECT count(*) FROM x) = (SELECT count(*) FROM u) + (SELECT count(*) FROM e) THEN 'PASS' ELSE 'FAIL' END AS status, 0e0 AS "limit"
UNION ALL SELECT 'disjoint', CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 0e0 FROM (SELECT site_id FROM u INTERSECT SELECT site_id FROM e)
UNION ALL SELECT 'subset', CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 0e0 FROM (SELECT site_id FROM p EXCEPT SELECT site_id FROM u)
UNION ALL SELECT 'all_operational', CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 0e0 FROM (SELECT site_id FROM u EXCEPT SELECT site_id FROM x WHERE op_status = 'OPERATIONAL')
UNION ALL SELECT 'apart', CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 0e0 FROM (SELECT site_id FROM u INTERSECT SELECT site_id FROM p)"""))
def set_gates(spark, sf_dir):
    """Sets that agree, and two that don't: supply isn't all operational, and the baseline isn't apart from supply."""
    from hexsite.operators import supply as S

    df = sites(spark, sf_dir)
    supply, rest = S.split_supply(df)
    baseline = df.filter(S.baseline_mask())
    out = G.reconciles("reconcile", df, supply, rest).unionByName(G.are_disjoint("disjoint", supply, rest, "site_id")).unionByName(G.is_subset("subset", baseline, supply, "site_id"))
    return out.unionByName(G.is_subset("all_operational", supply, df.filter("op_status = 'OPERATIONAL'"), "site_id")).unionByName(G.are_disjoint("apart", supply, baseline, "site_id"))


@query("se2_union_keys", oracle(f"SELECT DISTINCT cell FROM (SELECT {CELL} AS cell FROM pixels UNION SELECT {CELL} FROM poi UNION SELECT {CELL} FROM sites)"))
def union_keys(spark, sf_dir):
    one = lambda n: view(spark, sf_dir, n).select(grid.cell_of("lat", "lng").alias("cell"))
    return one("pixels").union(one("poi")).union(one("sites")).distinct()


@query("ms18_supply_without_road", oracle(RESOLVED + f", rd AS (SELECT DISTINCT {CELL} AS cell FROM pixels WHERE pixel % 3 = 0), s AS (SELECT DISTINCT {CELL} AS cell FROM x WHERE in_supply) SELECT count(*) AS n, count_if(cell NOT IN (SELECT cell FROM rd)) AS n_without FROM s"))
def without_road(spark, sf_dir):
    from hexsite.operators import supply as S

    s = S.split_supply(sites(spark, sf_dir))[0].select(grid.cell_of("lat", "lng").alias("cell")).distinct()
    r = view(spark, sf_dir, "pixels").filter("pixel % 3 = 0").select(grid.cell_of("lat", "lng").alias("cell")).distinct().withColumn("road", F.lit(1))
    return s.join(r, "cell", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("road").isNull()).alias("n_without"))


@query("ms5_failed_set", oracle("SELECT DISTINCT user_id AS station FROM events WHERE event_type = 'click' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 2 = 0)"))
def failed(spark, sf_dir):
    e = tables(spark, sf_dir, "events")["events"]
    return G.orphans(e.filter("event_type = 'click'").select(F.col("user_id").alias("station")), e.filter("event_type = 'purchase' AND user_id % 2 = 0").select(F.col("user_id").alias("station")), "station")


@query("ag32_tree_hash", oracle("SELECT sha256(string_agg(CAST(n_nationkey AS VARCHAR) || chr(9) || n_name || chr(9) || sha256(n_name), chr(10) ORDER BY n_nationkey)) AS tree FROM nation"))
def tree_hash(spark, sf_dir):
    from hexsite.sources.sinks import tree_digest

    n = tables(spark, sf_dir, "nation")["nation"]
    return tree_digest(n.select(F.col("n_nationkey").alias("path"), F.col("n_name").alias("size"), F.sha2(F.col("n_name").cast("binary"), 256).alias("sha256")))


@query("ag24_duplicates_by_tab", oracle("""
WITH c AS (SELECT l_suppkey AS code, l_returnflag AS tab, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT code, count(*) AS tabs, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n - 1) AS BIGINT) AS within_tab FROM c GROUP BY 1)
SELECT CAST(sum(within_tab) AS BIGINT) AS within_tab, CAST(sum(tabs - 1) AS BIGINT) AS across_tabs, count(*) AS codes FROM t"""))
def duplicates(spark, sf_dir):
    from hexsite.sources.readers import merge_first

    return merge_first(tables(spark, sf_dir, "lineitem")["lineitem"].select(F.col("l_suppkey").alias("code"), F.col("l_returnflag").alias("tab")), "code", "tab")[1]

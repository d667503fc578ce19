"""Rules with literal expectations: geometry, coordinates, mass, matching preconditions, sources and sinks."""

import json
import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexsite.functions import columns as K
from hexsite.functions import grid
from hexsite.functions.geo import resolve_area
from hexsite.operators import admin, connectors, coords, demand, match, siting, spatial, stats, supply
from hexsite.sources import readers, sinks


def box(x0, y0, x1, y1):
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)


def polygons(spark, rows):
    return spark.createDataFrame([(g, bytearray(admin.multi_wkb(p))) for g, p in rows], "grp string, geom binary")


def test_dissolve_takes_shared_edges_out(spark):
    rows = [("a", [[box(0, 0, 1, 1)]]), ("a", [[box(1, 0, 2, 2)]]), ("a", [[box(0, 1, 1, 2)]]), ("b", [[box(5, 5, 6, 6)]]), ("b", [[box(6, 6, 7, 7)]])]
    rows += [("ring", [[box(x, y, x + 1, y + 1)]]) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    got = {r["grp"]: r for r in admin.dissolve(polygons(spark, rows), "grp").collect()}
    assert {g: (r["n"], round(r["area"], 9)) for g, r in got.items()} == {"a": (3, 4.0), "b": (2, 2.0), "ring": (8, 8.0)}
    assert [len(p) for p in admin.read_wkb(bytes(got["ring"]["geom"]))] == [2]  # a hole
    assert len(admin.read_wkb(bytes(got["b"]["geom"]))) == 2  # they touch in a point
    inside = lambda g, x, y: admin.contains(admin.read_wkb(bytes(got[g]["geom"])), np.array([x]), np.array([y]))[0]
    assert inside("a", 1.0, 0.5) and inside("a", 1.0, 1.5) and not inside("ring", 1.5, 1.5)


def test_boundaries_from_lines():
    whole, used, missing = admin.assembled([np.array([(0, 0), (1, 0), (1, 1)], float), np.array([(0, 0), (0, 1), (1, 1)], float)])
    assert (used, missing) == (2, 0) and [admin.area(p[0]) for p in whole] == [1.0]
    partly, used, missing = admin.assembled([box(0, 0, 2, 2), np.array([(5, 5), (6, 5)], float), None])
    assert (used, missing) == (2, 1) and [admin.area(p[0]) for p in partly] == [4.0]
    assert admin.assembled([None]) == ([], 0, 1)
    assert admin.area(admin.largest_outer([box(0, 0, 1, 1), box(0, 0, 3, 1), np.zeros((3, 2))])) == 3.0
    assert admin.largest_outer([np.zeros((3, 2))]) is None
    assert admin.mostly_inside([[[box(0, 0, 2, 2)]], [[box(3, 0, 9, 1)]]], [[box(0, 0, 4, 4)]]) == [True, False]


def test_equal_area():
    # a degree square at 21 to 22 degrees: R * dlambda * R * (sin 22 - sin 21), whatever the parallel
    want = 6371.0088**2 * math.radians(1) * (math.sin(math.radians(22)) - math.sin(math.radians(21)))
    assert admin.equal_area_km2([[box(105, 21, 106, 22)]]) == pytest.approx(want, rel=1e-12)
    assert admin.equal_area_km2([[box(105, 21, 106, 22), box(105.2, 21, 105.4, 22)]]) == pytest.approx(0.8 * want)


def test_built_hectares(spark):
    pixels = spark.createDataFrame([(k, 21.0 + 0.001 * k, 105.0) for k in range(10)], "pixel int, lat double, lng double")
    got = admin.built_hectares(pixels, polygons(spark, [("a", [[box(104.9, 20.9, 105.1, 21.0045)]])]), "grp").collect()
    assert sum(r["built_ha"] for r in got) == pytest.approx(5 * 0.04) and {r["grp"] for r in got} == {"a"}


@pytest.mark.parametrize("lat, lng", [(60.0, 10.0), (-71.0, 179.9995), (0.0, -179.9995), (80.0, 179.99), (21.0, 105.0)])
def test_range_join_at_any_latitude(spark, lat, lng):
    draw = np.random.default_rng(1)
    turn = lambda x: (x + 180) % 360 - 180
    points = [(i, float(lat + draw.uniform(-0.02, 0.02)), float(turn(lng + draw.uniform(-0.02, 0.02) / math.cos(math.radians(lat))))) for i in range(120)]
    df = spark.createDataFrame(points, "id int, lat double, lng double")

    def far(a, b):
        x, y = math.radians(a[1]), math.radians(b[1])
        return 2 * 6371000 * math.asin(math.sqrt(math.sin((x - y) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(a[2] - b[2]) / 2) ** 2))

    got = [(r["id"], r["r_id"]) for r in spatial.self_pairs(df, "id", 900.0).collect()]
    want = {(a[0], b[0]) for i, a in enumerate(points) for b in points[i + 1 :] if far(a, b) <= 900}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 5


def test_nearest_goes_on_until_found(spark):
    left = spark.createDataFrame([(1, 21.0, 105.0), (2, 22.0, 105.0), (3, None, None)], "id int, lat double, lng double")
    right = spark.createDataFrame([(7, 21.001, 105.0), (8, 21.2, 105.0)], "to_id int, lat double, lng double")
    got = {r["id"]: r["nearest"] for r in spatial.nearest(left, "id", right, "to_id", [500.0, 5000.0, 200000.0]).collect()}
    assert got == {1: 7, 2: 8, 3: None}


def test_plain_text_decomposes(spark):
    texts = ["Łódź", unicodedata.normalize("NFD", "Đường Lê Lợi"), "ĐƯỜNG LÊ LỢI", "Ça va? Ñandú №5", "Ｆｕｌｌ ２", "ﬁ", "Thị xã Sơn Tây", None, ""]
    want = ["odz", "duong le loi", "duong le loi", "ca va nandu 5", "full 2", "", "thi xa son tay", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert [r["p"] for r in df.select(K.plain_text(F.col("t")).alias("p")).collect()] == want
    names = ["Thị xã Sơn Tây", "Phường Ba Đình", "Xã Phường An", "TP Huế", "Thành phố Huế", "Xãm X"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r["b"] for r in df.select(K.bare_name(F.col("n")).alias("b")).collect()] == ["thi xa son tay", "ba dinh", "phuong an", "hue", "hue", "xam x"]
    assert [r["k"] for r in df.select(K.commune_kind(F.col("n")).alias("k")).collect()] == ["UNKNOWN", "PHUONG", "XA", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_areas(spark):
    df = spark.createDataFrame([(23.65, 105.0), (23.75, 105.0), (None, 105.0)], "lat double, lng double")
    assert [r["i"] for r in df.select(resolve_area(None).contains("lat", "lng").alias("i")).collect()] == [True, False, False]
    hanoi = resolve_area("hanoi")
    assert (hanoi.lat, hanoi.lng) == (21.0278, 105.8342)


def test_repair_resolves_only_valid_points(spark):
    schema = "lat double, lng double, far boolean, stack int, suspect boolean, off_lat double, off_lng double, off_own_km double, off_stack int"
    rows = [
        (21.0, 105.0, False, 1, False, None, None, None, None), (None, None, False, 1, False, None, None, None, None), (95.0, 300.0, False, 1, False, None, None, None, None),
        (21.0, 105.0, True, 6, False, 21.5, 105.5, 10.0, 1), (21.0, 105.0, True, 6, False, 21.5, 105.5, 10.0, 9), (21.0, 105.0, True, 6, False, 95.0, 105.5, 10.0, 1),
    ]
    got = [(r["fix"], r["coord_resolved"], r["cell"] is None) for r in coords.repair(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("TRUSTED", True, False), ("INVALID", False, True), ("INVALID", False, True), ("SNAPPED", True, False), ("UNRESOLVED", False, True), ("UNRESOLVED", False, True)]


def test_verdicts_and_their_effects(spark):
    schema = "resolved boolean, outside boolean, flagged boolean, ok boolean, want string"
    rows = [
        (False, True, True, True, "NO_COORD"), (None, False, False, False, "NO_COORD"), (True, True, False, True, "COORD_BAD"), (True, True, True, True, "COORD_BAD"),
        (True, False, True, True, "COORD_CONFIRMED"), (True, False, True, False, "UNRESOLVED"), (True, False, False, False, "NOT_FLAGGED"), (True, None, None, None, "NOT_FLAGGED"),
    ]
    df = spark.createDataFrame(rows, schema).withColumn("got", admin.verdict(F.col("resolved"), F.col("outside"), F.col("flagged"), F.col("ok")))
    assert all(r["got"] == r["want"] for r in df.collect())
    schema = "verdict string, method string, coord_resolved boolean, cell long, coord_src string, flags array<string>, commune string"
    rows = [("COORD_BAD", "none", True, 5, "evcs", None, "x"), ("NOT_FLAGGED", "nearest", True, 5, "evcs", ["A"], "x"), ("NO_COORD", "inside", False, 5, "evcs", [], "x"), ("UNRESOLVED", "inside", True, 5, "evcs", [], "x")]
    got = [tuple(r[c] for c in ("coord_resolved", "cell", "coord_src", "method", "commune", "flags")) for r in admin.ruled(spark.createDataFrame(rows, schema), ["commune"]).collect()]
    assert got == [
        (False, None, "outside_admin", "unresolved", None, ["COORD_OUTSIDE_ADMIN"]), (True, 5, "evcs", "nearest", "x", ["A", "ADMIN_COORD_SNAPPED"]),
        (False, 5, "evcs", "unresolved", None, []), (True, 5, "evcs", "inside", "x", []),
    ]


def test_a_census_of_nothing_takes_nobody_away(spark):
    schema = "cell long, commune int, pop double, built double, bad boolean, census double"
    rows = [(1, 1, 500.0, 1.0, True, 0.0), (2, 1, 300.0, 3.0, False, 0.0), (3, 2, 900.0, 1.0, True, 100.0), (4, 3, 50.0, 0.0, True, 10.0), (5, None, 7.0, 1.0, True, None), (6, 4, 8.0, 1.0, False, 1.0)]
    empty = spark.createDataFrame([(9, 1, 4.0), (2, 1, 99.0), (10, 4, 1.0), (11, 2, 1.0), (11, 1, 8.0)], "cell long, commune int, built double")
    got = {r["cell"]: (r["pop"], round(r["pop_new"], 9), r["pop_src"]) for r in demand.retotal(spark.createDataFrame(rows, schema), bad=F.col("bad"), empty=empty).collect()}
    assert got == {
        1: (500.0, 50.0, "REDISTRIBUTED"), 2: (300.0, 150.0, "REDISTRIBUTED"), 9: (0.0, 200.0, "REDISTRIBUTED"), 11: (0.0, 400.0 + 42.95, "REDISTRIBUTED"), 3: (900.0, 42.95, "RETOTALED_DANSO"),
        4: (50.0, 50.0, "UNREPAIRED_NO_BUILTUP"), 5: (7.0, 7.0, "WORLDPOP"), 6: (8.0, 8.0, "WORLDPOP"),
    }


def test_reallocation_takes_off_what_the_census_denies(spark):
    schema = "cell long, commune int, pop double, built double, src boolean, census double, estimate double"
    rows = [(1, 1, 100.0, 0.0, True, 1000.0, 2000.0), (2, 1, 5.0, 2.0, False, 1000.0, 2000.0), (3, 2, 100.0, 0.0, True, 1000.0, 1400.0), (4, 2, 5.0, 1.0, False, 1000.0, 1400.0), (5, 3, 9.0, 0.0, True, 0.0, 9.0), (6, None, 3.0, 0.0, True, None, None)]
    df = demand.reallocate(spark.createDataFrame(rows, schema), source=F.col("src"), receiver=~F.col("src"), census="census", commune_pop="estimate")
    got = {r["cell"]: (round(r["pop_new"], 9), r["pop_src"]) for r in df.collect()}
    assert got == {1: (0.0, "MOVED_TO_ACCESSIBLE"), 2: (5.0 + 42.95, "WORLDPOP"), 3: (0.0, "MOVED_TO_ACCESSIBLE"), 4: (105.0, "WORLDPOP"), 5: (9.0, "UNREPAIRED_NO_ACCESSIBLE_BUILTUP"), 6: (3.0, "UNREPAIRED_NO_COMMUNE")}


def test_overlapping_zones_keep_all_flags(spark):
    cells = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 9.0, 9.0)], "cell long, lat double, lng double")
    zones = spark.createDataFrame([(0.0, 2.0, 0.0, 2.0, "MILITARY"), (0.5, 4.0, 0.5, 4.0, "AIRPORT")], "lat0 double, lat1 double, lng0 double, lng1 double, flag string")
    assert {r["cell"]: r["flags"] for r in spatial.zone_flags(cells, zones).collect()} == {1: ["AIRPORT", "MILITARY"], 2: ["AIRPORT"]}
    schema = "cell long, frac_water double, frac_wetland double, frac_crop double, built double, road_access double, road_len double, road_bridge double, access_tier string, substation_m double, pop double, zones array<string>"
    rows = [(1, 0.0, 0.0, 0.0, 0.5, 1.0, 1.0, 0.0, "DIRECT", 0.0, 1.0, ["MILITARY"]), (2, 0.0, 0.0, 0.0, 0.01, 0.0, 0.0, 0.0, "ISOLATED", None, 1.0, None), (3, 0.0, 0.0, 0.0, 0.5, 1.0, 1.0, 0.0, "DIRECT", 0.0, 1.0, [])]
    got = {r["cell"]: (r["buildable"], r["exclusion_flags"], r["penalty"]) for r in siting.feasibility(spark.createDataFrame(rows, schema), zones="zones").collect()}
    assert got == {1: (False, ["MILITARY"], 0.0), 2: (False, ["NOT_BUILT_UP", "ROAD_ACCESS_ISOLATED"], 0.7), 3: (True, [], 0.0)}


def test_tiers_are_looked_up_in_the_whole_table(spark):
    centre = spark.range(1).select(F.lit(21.0).alias("lat"), F.lit(105.5).alias("lng")).select(grid.cell_of("lat", "lng").alias("c")).first()["c"]
    roads = spark.createDataFrame([(centre, 9.0)], "cell long, road_access double")
    cells = [centre, centre + grid.ring(1)[0], centre + grid.ring(2)[0], centre + grid.ring(4)[0]]
    got = {r["cell"]: r["access_tier"] for r in demand.tiers_for(spark.createDataFrame([(c,) for c in cells], "cell long"), roads).collect()}
    assert [got[c] for c in cells] == ["DIRECT", "ADJACENT", "NEAR", "ISOLATED"]


def test_cross_reference_must_be_of_this_catalogue(spark):
    s = spark.createDataFrame([("a",), ("b",)], "station_code string")
    schema = "station_code string, source_master_sha256 string, official_matched boolean, confidence double"
    good = [("a", "h", True, 0.9), ("b", "h", None, None), ("c", "h", True, 1.0)]
    xref = lambda rows: spark.createDataFrame(rows, schema)
    got = {r["station_code"]: (r["confidence"], r["has_xref"]) for r in match.with_xref(s, xref(good), "h", ["official_matched", "confidence"]).collect()}
    assert got == {"a": (0.9, True), "b": (None, False)}
    for rows, digest, why in ((good, "other", "another"), ([*good, ("a", "h", True, 0.1)], "h", "repeat"), (good[:1], "h", "1 stations")):
        with pytest.raises(ValueError, match=why):
            match.with_xref(s, xref(rows), digest, ["official_matched"])


def test_scope_and_keywords(spark):
    df = spark.createDataFrame([("BATTERY_SWAP", "A"), (None, "Petrolimex số 5"), ("VINFAST_CS", None)], "station_type string, name string")
    assert supply.in_scope(df).count() == 2 and supply.in_scope(df, keep_swaps=True).count() == 3
    assert [r["k"] for r in df.select(K.any_keyword(["petrol", "xăng"], F.col("name"), F.lit(None).cast("string")).alias("k")).collect()] == [False, True, False]


def test_strata_and_recall(spark):
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate([5, 1, 1, 9, 7, 3, 8])], "k int, v double")
    got = {r["k"]: r["stratum"] for r in stats.strata(df, "k", "v").collect()}
    assert got == {1: "low", 2: "low", 5: "mid", 0: "mid", 4: "high", 6: "high", 3: "high"} or got == {1: "low", 2: "low", 5: "low", 0: "mid", 4: "mid", 6: "high", 3: "high"}
    hits = spark.createDataFrame([("low", True), ("low", False), ("high", True)], "stratum string, h boolean")
    r = stats.recall(hits, "k", {100: "h"})
    assert {(x["stratum"], x["n"], round(x["recall_100"], 3)) for x in r.collect()} == {("low", 2, 0.5), ("high", 1, 1.0), ("ALL", 3, 0.667)}
    assert stats.bias(r, 100).first()["ratio"] == 2.0
    ranks = {r["v"]: r["r"] for r in stats.average_rank(df, "v", "r").collect()}
    assert ranks == {1.0: 1.5, 3.0: 3.0, 5.0: 4.0, 7.0: 5.0, 8.0: 6.0, 9.0: 7.0}


def test_connector_ids_and_standards(spark):
    df = spark.createDataFrame([("s", '[{"type":0,"totalEvse":0},{"type":22000,"totalEvse":2},{"type":0,"totalEvse":1},5]')], "station string, p string")
    g = connectors.explode_groups(df, "station", "p")
    assert [r["connector_id"] for r in g.orderBy("idx").collect()] == ["s-c1", "s-c2"]
    first = connectors.first_standard(spark.createDataFrame([("s", 22.04, "CCS2", "DC", 2), ("s", 22.0, "TYPE2", "AC", 1)], "code string, kw double, standard string, current string, k int"), order=["k"])
    got = [(r["connector_standard"], r["current_type"], r["vehicle_class"], r["label"]) for r in connectors.with_standard(g, first, code="station").orderBy("idx").collect()]
    assert got == [("TYPE2", "AC", "CAR", "AC-22kW"), ("UNKNOWN", None, "UNVERIFIED", None)]
    config = "reg_guns long, reg_nameplate_kw double, reg_site_kw double, reg_shared boolean, live_guns long, live_total_kw double, witness long, reg_current string, live_current string"
    r = connectors.resolve_assets(spark.createDataFrame([(4, 240.0, 120.0, False, 4, 60.0, 1, "DC", "AC")], config)).first()
    assert r["current_type"] == "DC" and r["flags"] == ["CURRENT_TYPE"]


def test_quadtree_splits_what_is_full():
    points = [{"type": "node", "id": k, "lat": 20 + k / 100, "lng": 105 + (k * 7 % 100) / 100} for k in range(100)]
    asked = []

    def ask(b):
        asked.append(b)
        if len(asked) == 2:
            return None  # an error: split as well
        return [p for p in points if b[0] <= p["lat"] <= b[2] and b[1] <= p["lng"] <= b[3]][:20]

    got = readers.quadtree((20, 105, 21, 106), ask, cap=20, smallest=0.05)
    assert sorted(p["id"] for p in got) == list(range(100)) and len(asked) > 5
    assert readers.proven_radius([1.0, 5.0], 2) == 5.0 and readers.proven_radius([1.0], 2) == 0.0
    seeds = readers.seed_grid((20.0, 105.0, 20.2, 105.2), 5.0)
    assert len({lng for lat, lng in seeds if lat == seeds[0][0]} & {lng for lat, lng in seeds if lat == seeds[len(seeds) // 2][0]}) <= 1 or len(seeds) > 8
    assert all(20 <= lat <= 20.2 + 1e-9 and 105 <= lng <= 105.2 + 1e-9 for lat, lng in seeds)


def test_sources(spark, tmp_path):
    items = spark.createDataFrame([("a", "K", 1), ("a", "K", 0), (None, "K", 2), ("b", "J", 3)], "id string, kind string, v int")
    fit, bad = readers.well_formed(items, 4, "id", "kind", "K")
    assert [tuple(r) for r in fit.select("id", "v").collect()] == [("a", 0)] and bad == 1
    with pytest.raises(ValueError):
        readers.well_formed(items, 5, "id", "kind", "K")
    relations = spark.createDataFrame([(1, [(7, "outer"), (8, "inner"), (9, "outer")])], "relation int, members array<struct<way:int,role:string>>")
    ways = spark.createDataFrame([(7, [(0.0, 0.0), (1.0, 0.0)])], "way int, points array<struct<x:double,y:double>>")
    r = readers.boundary_lines(relations, ways).first()
    assert (len(r["ways"]), r["missing"]) == (1, 1)
    calls = []
    fetch = lambda: calls.append(1) or spark.range(3)
    path = f"{tmp_path}/raw"
    assert [readers.frozen(spark, path, fetch).count(), readers.frozen(spark, path, fetch).count(), readers.frozen(spark, path, fetch, refetch=True).count()] == [3, 3, 3] and len(calls) == 2
    source = readers.Source("osm", ["a", "b"], "ODbL", "2024")
    assert readers.missing_members(source, {"b"}) == ["a"]
    tiers = {"fast": "FAST"}
    assert readers.telemetry_tier("x/slow/y", tiers, "SLOW") == "SLOW" and readers.telemetry_tier("x/fast", tiers, "SLOW", "r1") == "FAST"
    with pytest.raises(ValueError):
        readers.telemetry_tier("x/fast", tiers, "SLOW")


def test_sinks(spark, tmp_path):
    sinks.write_text(spark, f"{tmp_path}/p", "one")
    sinks.write_text(spark, f"{tmp_path}/p", "two")
    assert sinks.read_text(spark, f"{tmp_path}/p") == "two" and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["p"]
    df = spark.createDataFrame([(1, 21.12345678, 105.5, ["BAD"]), (2, None, 105.0, [])], "id int, lat double, lng double, flags array<string>")
    sinks.feature_collection(df.drop("flags"), f"{tmp_path}/f.json")
    got = json.loads((tmp_path / "f.json").read_text())
    assert got["type"] == "FeatureCollection" and got["features"][0]["geometry"]["coordinates"] == [105.5, 21.123457]
    with pytest.raises(ValueError):
        sinks.feature_collection(df.drop("flags"), f"{tmp_path}/g.json", most=1)
    sinks.dump_flagged(df, "flags", ["BAD"], f"{tmp_path}/bad", ["id"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/bad").count() == 1
    sinks.series_files(spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "s string, t int"), f"{tmp_path}/series", "s", "t")
    assert [r["t"] for r in spark.read.parquet(f"{tmp_path}/series/s=a").collect()] == [1, 2]
    tables = {"stations": df.select("id", "lat")}
    how = dict(required={"stations": ["id"]}, keys={"stations": ["id"]}, forbidden=["secret"])
    m = sinks.bundle(spark, f"{tmp_path}/out", tables, **how)
    assert m.count() >= 1 and spark.read.parquet(f"{tmp_path}/out/stations").count() == 2
    listed = json.loads((tmp_path / "out" / "MANIFEST.json").read_text())
    assert listed["tree"] == sinks.tree_of([(f["path"], f["size"], f["sha256"]) for f in listed["files"]])
    assert listed["tree"] == sinks.tree_digest(m).first()["tree"]
    with pytest.raises(FileExistsError):
        sinks.bundle(spark, f"{tmp_path}/out", tables, **how)
    with pytest.raises(ValueError):
        sinks.bundle(spark, f"{tmp_path}/other", {"stations": df.select("lat")}, **how)
    with pytest.raises(ValueError):
        sinks.bundle(spark, f"{tmp_path}/twice", {"stations": df.union(df).select("id")}, **how)
    sinks.freeze(spark, f"{tmp_path}/m", "{}", "1")
    sinks.freeze(spark, f"{tmp_path}/m", "{}", "2")
    assert json.loads((tmp_path / "m" / "MANIFEST-1.json").read_text())["version"] == "1"
    with pytest.raises(FileExistsError):
        sinks.freeze(spark, f"{tmp_path}/m", "{}", "2")


def test_one_apartment_a_complex(spark):
    rows = [(1, "APARTMENT", "UNKNOWN", True, True, 5), (2, "APARTMENT", "UNKNOWN", True, True, 5), (3, "APARTMENT", "UNKNOWN", True, True, None), (4, "PARKING_OFF", "RESTRICTED", True, True, None), (5, "PARKING_OFF", "UNKNOWN", True, True, None), (6, "FUEL", None, None, True, None), (7, "FUEL", None, True, False, None), (8, "ZOO", None, True, True, None)]
    df = spark.createDataFrame(rows, "poi int, class string, access string, in_country boolean, is_primary boolean, complex int")
    assert {(r["poi"], r["tier"]) for r in siting.poi_anchors(df).collect()} == {(1, "T2"), (3, "T2"), (5, "T1")}

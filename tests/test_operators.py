"""Operators against brute force and against cases that must fail."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from hexsite.functions import columns as K
from hexsite.functions import grid
from hexsite.functions.geo import resolve_area
from hexsite.functions.similarity import common_length, token_set_ratio
from hexsite.operators import admin, connectors, coords, demand, gates, match, siting, spatial, supply, telemetry
from hexsite.operators.graph import components
from hexsite.sources import readers, sinks
from hexsite.streaming import ingest


def test_grid_counts_and_centres(spark):
    for k in range(5):
        assert len(grid.steps(k)) == 1 + 3 * k * (k + 1)
    draw = random.Random(1)
    points = [(i, draw.uniform(8, 23), draw.uniform(102, 110)) for i in range(300)]
    df = spark.createDataFrame(points, "i int, lat double, lng double").withColumn("cell", grid.cell_of("lat", "lng"))
    back = df.withColumn("clat", grid.centre_lat("cell")).withColumn("clng", grid.centre_lng("cell"))
    rows = back.withColumn("again", grid.cell_of("clat", "clng")).collect()
    for r in rows:
        assert r["again"] == r["cell"]
        x, y = (r["lng"] - r["clng"]) * grid.KX, (r["lat"] - r["clat"]) * grid.KY
        assert math.hypot(x, y) <= grid.SPACING / math.sqrt(3) + 1e-9
        hexagon = np.array([(b, a) for a, b in grid.boundary(r["cell"])])
        assert admin.contains([[np.vstack([hexagon, hexagon[:1]])]], np.array([r["clng"]]), np.array([r["clat"]]))[0]
    assert spark.createDataFrame([(None, 1.0)], "lat double, lng double").select(grid.cell_of("lat", "lng").alias("c")).first()["c"] is None


def test_components_of_random_graphs(spark):
    draw = random.Random(2)
    for n, m in ((30, 20), (40, 60), (60, 30)):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 130)]
        parent = list(range(200))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_range_join_finds_all(spark):
    draw = random.Random(3)
    points = [(i, 21 + draw.random() * 0.05, 105 + draw.random() * 0.05) for i in range(120)] + [(999, None, 105.0)]
    df = spark.createDataFrame(points, "id int, lat double, lng double")
    got = {(r["id"], r["r_id"]) for r in spatial.self_pairs(df, "id", 700.0).collect()}
    far = lambda a, b: 2 * 6371000 * math.asin(math.sqrt(math.sin(math.radians(a[1] - b[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(a[2] - b[2]) / 2) ** 2))
    assert got == {(a[0], b[0]) for a, b in itertools.combinations(points[:-1], 2) if far(a, b) <= 700}


def test_similarity():
    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    draw = random.Random(4)
    for _ in range(200):
        a, b = ("".join(draw.choice("abc ") for _ in range(draw.randrange(15))) for _ in range(2))
        assert common_length(a, b) == lcs(a, b)
        assert token_set_ratio(a, b) == pytest.approx(token_set_ratio(b, a))
    assert token_set_ratio("tram sac a", "a tram sac") == 100
    assert token_set_ratio("", "x") == 0 == token_set_ratio(None, None)


def test_hexagons_over_polygons(spark):
    box = lambda x0, y0, x1, y1: admin.wkb([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])
    polygons = spark.createDataFrame([("a", bytearray(box(105.0, 21.0, 105.05, 21.1))), ("b", bytearray(box(105.05, 21.0, 105.1, 21.1)))], "name string, geom binary")
    draw = random.Random(5)
    points = spark.createDataFrame([(21 + draw.random() * 0.1, 105 + draw.random() * 0.1, 10.0) for _ in range(60)], "lat double, lng double, pop double")
    cells = points.groupBy(grid.cell_of("lat", "lng").alias("cell")).agg(F.sum("pop").alias("pop"))
    found = admin.cell_overlaps(cells, polygons, "name").collect()
    weights = {}
    for r in found:
        weights[r["cell"]] = weights.get(r["cell"], 0) + r["w"]
        hexagon = np.array([(b, a) for a, b in grid.boundary(r["cell"])])
        g = np.random.default_rng(1)
        x, y = g.uniform(*np.percentile(hexagon[:, 0], [0, 100]), 20000), g.uniform(*np.percentile(hexagon[:, 1], [0, 100]), 20000)
        inside = admin.contains([[np.vstack([hexagon, hexagon[:1]])]], x, y)
        left, right = (105.0, 105.05) if r["name"] == "a" else (105.05, 105.1)
        share = (inside & (x >= left) & (x <= right) & (y >= 21) & (y <= 21.1)).sum() / inside.sum()
        assert abs(share - r["area_share"]) < 0.02
    assert all(abs(w - 1) < 1e-9 for w in weights.values())
    rolled = admin.weighted_rollup(admin.cell_overlaps(cells, polygons, "name"), cells, "name", ["pop"], polygons).collect()
    assert sum(r["pop"] for r in rolled) == pytest.approx(600.0)


def test_multipolygon_with_hole():
    outer, hole = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (2, 1), (2, 2), (1, 2)]
    one = admin.wkb([outer, hole])
    many = b"\x01\x06\x00\x00\x00\x02\x00\x00\x00" + one + admin.wkb([[(6, 0), (7, 0), (7, 1), (6, 1)]])
    got = admin.contains(admin.read_wkb(many), np.array([0.5, 1.5, 6.5, 5.0]), np.array([0.5, 1.5, 0.5, 0.5]))
    assert got.tolist() == [True, False, True, False]


def test_greedy_is_near_the_best(spark):
    draw = random.Random(6)
    cover = {s: {draw.randrange(12) for _ in range(4)} for s in range(7)}
    weight = {c: float(draw.randrange(1, 9)) for c in range(12)}
    covered = spark.createDataFrame([(s, c) for s, cs in cover.items() for c in cs], "site int, cell int")
    weights = spark.createDataFrame(list(weight.items()), "cell int, w double")
    chosen = [r["site"] for r in siting.greedy(covered, "site", weights, "w", 3).collect()]
    value = lambda sites: sum(weight[c] for c in set().union(*(cover[s] for s in sites)))
    best = max(value(s) for s in itertools.combinations(cover, 3))
    assert value(chosen) >= (1 - 1 / math.e) * best
    assert value(chosen[:1]) == max(value([s]) for s in cover)


def test_gates_can_fail(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, None)], "id int, ok boolean")
    report = gates.evaluate(df, [gates.unique("pk", "id"), gates.none_where("bad", ~F.col("ok")), gates.share_of("rate", F.col("ok"), 0.3), gates.none_where("soft", F.col("id") == 2, warn=True)])
    assert {r["gate"]: r["status"] for r in report.collect()} == {"pk": "FAIL", "bad": "FAIL", "rate": "PASS", "soft": "WARN"}
    with pytest.raises(gates.GateFailed, match="pk, bad"):
        gates.enforce(report)
    empty = gates.evaluate(df.limit(0), [gates.unique("pk", "id"), gates.share_of("rate", F.col("ok"), 0.9)])
    assert all(r["status"] == "PASS" for r in empty.collect())


def test_status_prefers_the_registry(spark):
    df = spark.createDataFrame([("INACTIVE", "Available", None, True), (None, "OutOfService", "Public", None), (None, None, None, None)], "registry_status string, live_status string, registry_access string, is_public boolean")
    got = [(r["op_status"], r["access"], r["is_operational"], r["flags"]) for r in supply.resolve_status(df).collect()]
    assert got == [("MAINTENANCE", "PUBLIC", True, ["UNDER_MAINTENANCE"]), ("OUT_OF_SERVICE", "PUBLIC", False, ["NOT_OPERATIONAL"]), ("UNKNOWN", "UNKNOWN", True, ["STATUS_UNKNOWN", "ACCESS_UNKNOWN"])]


def test_assets_keep_unknown(spark):
    schema = "reg_guns long, reg_nameplate_kw double, reg_site_kw double, reg_shared boolean, live_guns long, live_total_kw double, witness long"
    rows = [(4, 240.0, 120.0, True, 2, 60.0, 1), (None, None, None, None, 2, 60.0, 5), (None, None, None, None, 0, None, 3), (None, None, None, None, None, None, None)]
    got = [(r["config_src"], r["n_guns_installed"], r["site_kw"], r["flags"]) for r in connectors.resolve_assets(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("OFFICIAL", 4, 120.0, ["TRUNCATED", "CABINET"]), ("EVCS_LIVE", 5, 60.0, []), ("TELEMETRY_BOUND", 3, None, ["LOWER_BOUND"]), ("UNKNOWN", None, None, ["UNKNOWN"])]


def test_history_payloads(spark):
    rows = [('[[1,"2"],[3,4],["x",5]]',), ('[{"timestamp":7,"value":1},{"value":2}]',), ("{}",), (None,), ("[]",)]
    got = [r["h"] for r in spark.createDataFrame(rows, "p string").select(telemetry.parse_history("p").alias("h")).collect()]
    assert [(x["ts"], x["value"]) for x in got[0]["points"]] == [(1, "2"), (3, "4")]
    assert got[0]["n_bad"] == 1
    assert [(x["ts"], x["value"]) for x in got[1]["points"]] == [(7, "1")]
    assert got[2] is None or got[2]["points"] == []
    assert got[3] is None
    assert got[4]["points"] == []


def test_coordinates_are_repaired(spark):
    schema = "id int, lat double, lng double, far boolean, stack int, suspect boolean, off_lat double, off_lng double, off_own_km double, off_stack int"
    rows = [(1, 21.0, 105.8, False, 9, False, None, None, None, None), (2, 10.0, 106.0, True, 5, False, 21.0, 105.8, 3.0, 1), (3, 10.0, 106.0, True, 5, False, None, None, None, None), (4, 10.0, 106.0, True, 2, True, 21.0, 105.8, 300.0, 1)]
    got = {r["id"]: (r["fix"], r["coord_resolved"], r["cell"] is None, r["lat_raw"]) for r in coords.repair(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("TRUSTED", True, False, 21.0), 2: ("SNAPPED", True, False, 10.0), 3: ("UNRESOLVED", False, True, 10.0), 4: ("UNRESOLVED", False, True, 10.0)}


def test_duplicates_and_blobs(spark):
    schema = "id string, name string, address string, lat double, lng double, store string, own_code string, exact boolean, matched boolean, confidence double, has_series boolean"
    near = lambda k: 21.0 + k * 1e-5
    rows = [
        ("a", "Tram sac Ha Noi", "", near(0), 105.0, None, "a", False, False, 0.5, True),
        ("b", "Tram sac Ha Noi 2", "", near(1), 105.0, None, "b", True, True, 0.9, True),
        ("c", "Cua hang khac", "", near(2), 105.0, None, "c", False, False, 0.1, False),
        ("d", "x", "", 10.0, 106.0, "S1", "d", False, False, 0.1, False),
        ("e", "y", "", 22.0, 104.0, "S1", "e", False, True, 0.1, False),
        *[(f"m{i}", "Mot ten chung", "", 15.0 + i * 1e-5, 108.0, None, f"m{i}", False, False, 0.1, False) for i in range(6)],
    ]
    got = {r["id"]: (r["group"], r["is_primary"], r["blob"]) for r in match.physical_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"] == ("a", False, False)
    assert got["b"] == ("a", True, False)
    assert got["c"] == ("c", True, False)
    assert (got["d"], got["e"]) == (("d", False, False), ("d", True, False))
    assert all(got[f"m{i}"] == (f"m{i}", True, True) for i in range(6))


def test_reallocation_keeps_the_mass(spark):
    rows = [(i, i % 4 if i % 11 else None, float(i), i % 3 == 0, float(i % 5)) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "cell long, commune int, pop double, src boolean, built double")
    out = demand.reallocate(df, source=F.col("src"), receiver=~F.col("src"))
    a, b = out.agg(F.sum("pop"), F.sum("pop_new")).first()
    assert a == pytest.approx(b, rel=1e-9)
    assert out.filter("pop_src = 'MOVED' AND pop_new <> 0").count() == 0


def test_text_columns(spark):
    row = spark.createDataFrame([("C.HNI0012 / Đường Số 1", "Phường Bến Nghé", "a;;b|c", "7.0")], "code string, name string, flags string, n string")
    got = row.select(K.slug(F.col("code")).alias("s"), K.province_code(F.col("code")).alias("p"), K.bare_name(F.col("name")).alias("b"), K.split_flags(F.col("flags")).alias("f"), K.number_in(F.col("n"), 1, 12).alias("n"), K.power_label(F.lit("DC"), F.lit(120.0)).alias("l"), K.power_label(F.lit("AC"), F.lit(3.5)).alias("l2"), K.local_time(F.lit(0)).alias("t")).first()
    assert tuple(got) == ("vn-c-hni0012-ng-s-1", "HNI", "ben nghe", ["a", "b", "c"], 7.0, "DC-120kW", "AC-3.5kW", "1970-01-01 07:00:00")
    assert resolve_area(None).contains("lat", "lng") is not None
    with pytest.raises(ValueError, match="preset"):
        resolve_area("atlantis")


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("01", 1, 21.0, 105.0, ["A", "B"]), ("02", 2, float("nan"), 106.0, [])], "province string, id int, lat double, lng double, flags array<string>")
    df.write.partitionBy("province").parquet(str(tmp_path / "hive"))
    assert {r["province"] for r in readers.partitioned(spark, str(tmp_path / "hive"), "id int, lat double, province string").collect()} == {"01", "02"}

    root = str(tmp_path / "table")
    first = sinks.write_generation(root, stations=df, connectors=df.select("id"))
    second = sinks.write_generation(root, stations=df.limit(1), connectors=df.select("id"))
    assert first != second
    assert sinks.read_generation(spark, root, "stations").count() == 1

    bad = gates.evaluate(df, [gates.none_where("two", F.col("id") == 2)])
    with pytest.raises(gates.GateFailed):
        sinks.write_if(df, str(tmp_path / "never"), bad, str(tmp_path / "report.json"))
    assert not (tmp_path / "never").exists()
    assert json.loads((tmp_path / "report.json").read_text())["overall"] == "FAIL"

    sinks.quarantine(df, F.col("id") == 1, str(tmp_path / "good"), str(tmp_path / "rest"))
    assert spark.read.parquet(str(tmp_path / "good")).count() + spark.read.parquet(str(tmp_path / "rest")).count() == 2

    sinks.csv_with_bom(df.coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*")).read_text("utf-8")
    assert text.startswith("﻿id") or text.startswith("﻿province") or text.startswith('"﻿')
    assert "['A', 'B']" in text
    feature = json.loads(sinks.feature_lines(df.limit(1), "lat", "lng").first()["value"])
    assert feature["geometry"]["coordinates"] == [105.0, 21.0]

    have = sinks.manifest(spark, str(tmp_path / "good"))
    assert sinks.verify_manifest(have, have).count() == 0
    assert {r["state"] for r in sinks.verify_manifest(have, have.withColumn("size", F.col("size") + 1)).collect()} == {"DIFFERENT"}

    (tmp_path / "series").mkdir()
    (tmp_path / "series/s1.csv").write_text("timestamp,n\n1,2\n3,x\n")
    rows = readers.series_directory(spark, str(tmp_path / "series"), "timestamp long, n int").collect()
    assert {(r["station"], r["timestamp"], r["n"]) for r in rows} == {("s1", 1, 2), ("s1", 3, None)}

    merged = readers.first_wins(readers.in_order(df.select("id", "lat"), df.select("id", F.lit(0.0).alias("lat"), F.lit(1).alias("extra"))), "id", ["src_rank"])
    assert {(r["id"], r["src_rank"]) for r in merged.collect()} == {(1, 0), (2, 0)}
    found, path = readers.first_readable(spark, [(str(tmp_path / "none"), ["id"]), (str(tmp_path / "good"), ["other"]), (str(tmp_path / "rest"), ["id"])])
    assert path.endswith("rest") and found.count() == 1
    with pytest.raises(ValueError, match="2 rows of 3"):
        readers.complete(df, 3)
    with pytest.raises(ValueError, match="missing"):
        readers.assert_schema(df, ["nope"])
    assert readers.newest(spark.createDataFrame([("a", 1, True), ("b", 2, False)], "path string, generation int, ok boolean"), usable=F.col("ok")) == "a"


def test_streams(spark, tmp_path):
    schema = "station long, ts timestamp, cars long"
    rows = [Row(station=s, ts=f"2024-01-01 {h:02d}:10:00", cars=h * s) for s in (1, 2) for h in range(5)]
    df = spark.createDataFrame(rows + rows[:3]).withColumn("ts", F.to_timestamp("ts"))
    df.select("station", "ts", "cars").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.telemetry_stream(spark, str(tmp_path / "in"), schema)
    ingest.run_once(ingest.unique_readings(stream()), str(tmp_path / "out"), str(tmp_path / "c1"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    ingest.run_once(ingest.unique_readings(stream()), str(tmp_path / "out"), str(tmp_path / "c1"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    ingest.run_once(ingest.windowed(stream()), str(tmp_path / "win"), str(tmp_path / "c2"))
    assert spark.read.parquet(str(tmp_path / "win")).count() >= 4
    query = ingest.running_peak(stream()).writeStream.outputMode("update").format("memory").queryName("peaks").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r["station"], r["peak"]) for r in spark.sql("SELECT station, max(peak) AS peak FROM peaks GROUP BY 1").collect()} == {(1, 4), (2, 8)}


def test_distance_of_unknown_places_is_unknown(spark):
    from hexsite.functions.geo import haversine_m

    rows = spark.createDataFrame([(None, 105.0, 21.0, 105.0), (21.0, 105.0, 21.0, 105.0), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    got = [r["m"] for r in rows.select(haversine_m("a", "b", "c", "d").alias("m")).collect()]
    assert got[0] is None and got[1] == 0 and got[2] == pytest.approx(math.pi * 6_371_000)

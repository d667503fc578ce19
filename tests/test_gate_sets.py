"""Each set of gates passes on a sound table, and each gate of it fails on a fault of its own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.operators import gate_sets as S
from hexsite.operators import gates as G


def statuses(spark, row, schema, gates, *more):
    df = spark.createDataFrame([row, *more], schema)
    return {r["gate"]: r["status"] for r in G.evaluate(df, gates).collect()}


def check(spark, schema, sound, gates, faults):
    """``faults``: gate to the fields that break it."""
    got = statuses(spark, tuple(sound.values()), schema, gates)
    assert set(got.values()) == {"PASS"}, got
    assert set(faults) <= set(got)
    for gate, change in faults.items():
        broken = statuses(spark, tuple({**sound, **change}.values()), schema, gates)
        assert broken[gate] in ("FAIL", "WARN"), (gate, broken)


def test_dedup(spark):
    schema = "id long, physical long, is_primary boolean, `group` long, method string, n_members int, flags array<string>"
    sound = {"id": 1, "physical": 1, "is_primary": True, "group": 1, "method": "coord_name", "n_members": 2, "flags": []}
    check(spark, schema, sound, S.dedup(), {"reconcile": {"is_primary": None}, "no_over_merge": {"n_members": 5}, "primary_is_self": {"physical": 2}, "dup_labeled": {"is_primary": False}})
    assert statuses(spark, tuple(sound.values()), schema, S.dedup(), (2, 1, True, 1, "coord_name", 2, []))["physical_id_unique"] == "FAIL"


def test_coords(spark):
    cell = spark.range(1).select(F.lit(21.0).alias("lat"), F.lit(105.5).alias("lng")).select(grid.cell_of("lat", "lng").alias("c")).first()["c"]
    schema = "coord_src string, lat_raw double, lng_raw double, lat double, lng double, coord_resolved boolean, cell long, flags array<string>"
    sound = {"coord_src": "evcs", "lat_raw": 21.0, "lng_raw": 105.5, "lat": 21.0, "lng": 105.5, "coord_resolved": True, "cell": cell, "flags": []}
    faults = {"provenance_complete": {"lat_raw": None}, "unresolved_no_cell": {"coord_resolved": False}, "no_unfixed_placeholder_in_supply": {"flags": ["COORD_PLACEHOLDER"]}, "placeholder_labeled": {"flags": ["COORD_PLACEHOLDER"]}, "cell_consistent": {"cell": 1}}
    check(spark, schema, sound, S.coords(), faults)
    assert statuses(spark, ("official", 21.0, 105.5, 21.0, 105.5, True, cell, ["COORD_PLACEHOLDER"]), schema, S.coords())["no_unfixed_placeholder_in_supply"] == "PASS"


def test_config(spark):
    schema = "config_src string, config_resolved boolean, n_guns_installed long, live_guns long, witness long, nameplate_kw double, site_kw double, current_type string, flags array<string>, is_operational boolean, in_supply boolean"
    sound = {"config_src": "OFFICIAL", "config_resolved": True, "n_guns_installed": 4, "live_guns": 2, "witness": 3, "nameplate_kw": 120.0, "site_kw": 60.0, "current_type": "DC", "flags": [], "is_operational": True, "in_supply": True}
    faults = {
        "guns_ge_observed_max": {"witness": 5}, "no_silent_zero": {"n_guns_installed": 0, "witness": 0}, "reporting_le_installed": {"live_guns": 9}, "asset_layer_complete": {"current_type": None},
        "site_power_le_nameplate": {"site_kw": 121.0}, "unknown_is_explicit": {"config_src": "UNKNOWN", "config_resolved": False}, "row_reconciliation": {"config_resolved": False}, "config_resolved_rate": {"config_resolved": False},
    }
    check(spark, schema, sound, S.config(), faults)


def test_admin(spark):
    schema = "coord_resolved boolean, commune int, known boolean, verdict string, cell long, in_supply boolean"
    sound = {"coord_resolved": True, "commune": 1, "known": True, "verdict": "NOT_FLAGGED", "cell": 5, "in_supply": True}
    faults = {"admin_join_rate": {"commune": None}, "admin_iff_coord_resolved": {"coord_resolved": False}, "admin_vintage_single": {"known": False}, "outside_admin_excluded": {"verdict": "COORD_BAD"}, "supply_fully_labelled": {"commune": None}}
    check(spark, schema, sound, S.admin_stations(), faults)
    schema = "province string, label int, purity double, status string"
    check(spark, schema, {"province": "HN", "label": 1, "purity": 0.95, "status": "OK"}, S.crosswalk(["NA"], 1), {"crosswalk_total": {"purity": 0.5}, "ambiguous_codes_are_nonprovince": {"status": "AMBIGUOUS"}})
    assert statuses(spark, ("NA", None, 0.5, "AMBIGUOUS"), schema, S.crosswalk(["NA"], 1)) == {"crosswalk_total": "FAIL", "ambiguous_codes_are_nonprovince": "PASS"}
    schema = "pop double, given double, joined boolean, centred boolean, w double, label_share double, max_share double"
    sound = {"pop": 10.0, "given": 10.0, "joined": True, "centred": False, "w": 1.0, "label_share": 0.6, "max_share": 0.6}
    check(spark, schema, sound, S.admin_grid(), {"conservation": {"given": 9.0}, "join_rate": {"joined": False}, "hex_beats_centroid": {"centred": True}, "weights_sum_to_one": {"w": 0.9}, "label_is_argmax": {"label_share": 0.3}})
    schema = "commune int, province int, n_cells long, landless boolean"
    check(spark, schema, {"commune": 1, "province": 1, "n_cells": 3, "landless": False}, S.commune_rollup(1), {"communes_covered": {"n_cells": None}, "vintage_single": {"province": None}})


def test_supply_and_coverage(spark):
    schema = "id long, in_supply boolean, reason string, lat double, lng double, cell long"
    out = {"id": 1, "in_supply": False, "reason": "RESTRICTED", "lat": 21.0, "lng": 105.0, "cell": 5}
    check(spark, schema, out, S.supply_export(), {"reconciles_input": {"in_supply": None}, "every_excluded_has_reason": {"reason": None}, "reasons_are_known": {"reason": "OTHER"}, "supply_has_geometry": {"in_supply": True, "lat": None}})
    twice = statuses(spark, tuple(out.values()), schema, S.supply_export(), (1, True, None, 21.0, 105.0, 5), (1, True, None, 21.0, 105.0, 5))
    assert twice["pk_unique"] == "FAIL" and twice["sets_are_disjoint"] == "FAIL"
    schema = "id long, cell long, baseline boolean, operational boolean, coord_resolved boolean"
    sound = {"id": 1, "cell": 5, "baseline": True, "operational": True, "coord_resolved": True}
    check(spark, schema, sound, S.covered(1), {"subset_of_supply": {"coord_resolved": None}, "cell_not_null": {"cell": None}, "operational_subset_of_baseline": {"baseline": False}})
    twice = statuses(spark, tuple(sound.values()), schema, S.covered(1), tuple(sound.values()))
    assert twice["pk_unique"] == "FAIL" and twice["reconciles_area"] == "FAIL"
    schema = "share double, n long, ratio double"
    check(spark, schema, {"share": 0.95, "n": 200, "ratio": 0.99}, S.candidates(20, 3000, 3.0), {"upper_bound_coverage": {"share": 0.8}, "freedom_ratio": {"n": 99}, "size_ceiling": {"n": 3001}, "anti_degenerate": {"ratio": 0.5}})
    assert statuses(spark, (0.95, 200, 0.99), schema, S.candidates(20, 3000, grid.SPACING))["grid_radius"] == "FAIL"


def test_demand_and_mass(spark):
    schema = "cell long, kept boolean, cell_state string, pop double, pop_adj double, road_len double, road_access double, road_bridge double, near double, far double, access_tier string"
    sound = {"cell": 1, "kept": True, "cell_state": "INSIDE", "pop": 9.0, "pop_adj": 9.0, "road_len": 1.0, "road_access": 2.0, "road_bridge": 0.0, "near": 0.0, "far": 0.0, "access_tier": "DIRECT"}
    faults = {
        "non_negative": {"pop_adj": -1.0}, "road_len_le_access": {"road_len": 3.0}, "road_bridge_le_access": {"road_bridge": 3.0}, "clip_pop_loss_negligible": {"kept": False},
        "no_outside_cell_in_grid": {"cell_state": "OUTSIDE"}, "access_tier_consistent": {"access_tier": "NEAR"}, "no_pop_left_isolated": {"access_tier": "ISOLATED", "road_access": 0.0},
    }
    check(spark, schema, sound, S.demand(["pop", "pop_adj"]), faults)
    assert statuses(spark, tuple(sound.values()), schema, S.demand(["pop"]), tuple(sound.values()))["unique_cell"] == "FAIL"
    schema = "pop double, pop_before double, largest double, bad boolean, commune int, pop_new double, pop_src string"
    sound = {"pop": 900.0, "pop_before": 900.0, "largest": 5.0, "bad": False, "commune": 1, "pop_new": 900.0, "pop_src": "WORLDPOP"}
    # a commune of 800 people that becomes 0, with nobody saying so
    faults = {"pop_invariant": {"pop_before": 901.0}, "no_unflagged_implausible_pixel": {"largest": 1001.0}, "flagged_mass_share": {"bad": True}, "global_mass_accounted": {"pop_new": 0.0}, "national_drift_lt_1pct": {"pop_new": 100.0}, "retotal_only_reduces": {"pop_new": 905.0, "pop_src": "RETOTALED_DANSO"}, "commune_join_coverage": {"commune": None}}
    check(spark, schema, sound, S.dasymetric(), faults)
    schema = "pop double, pop_before double, before double, pop_new double, cut double, access_tier string, pop_src string"
    moved, got = (9.0, 9.0, 9.0, 0.0, 0.0, "NEAR", "MOVED_TO_ACCESSIBLE"), (1000.0, 1000.0, 1000.0, 1009.0, 0.0, "DIRECT", "WORLDPOP")
    run = lambda a, b: statuses(spark, a, schema, S.roadless(), b)
    assert set(run(moved, got).values()) == {"PASS"}
    assert run((*moved[:3], 9.0, *moved[4:]), got)["no_unlabelled_roadless_pop"] == "FAIL"
    assert run((*moved[:3], 12.0, *moved[4:]), got)["received_mass_is_direct"] == "FAIL"
    assert run((*moved[:3], 9.0, *moved[4:]), got)["roadless_mass_decreases"] == "FAIL"
    assert run(moved, (*got[:3], 1000.0, *got[4:]))["global_mass_accounted"] == "FAIL"
    assert run(moved, (8.0, *got[1:]))["pop_invariant"] == "FAIL"


def test_raster_and_osm(spark):
    check(spark, "total double, rho double, same_cells boolean, ratio_std double", {"total": 100.0, "rho": 1.0, "same_cells": True, "ratio_std": 0.0}, S.raster(100.0), {"total_matches": {"total": 101.0}, "rank_invariant": {"same_cells": False}, "ratio_is_constant": {"ratio_std": 0.1}})
    schema = "poi long, class string, in_country boolean, is_primary boolean, physical_known boolean, levels double, lat double, lng double, cell long"
    sound = {"poi": 1, "class": "APARTMENT", "in_country": True, "is_primary": True, "physical_known": True, "levels": 5.0, "lat": 21.0, "lng": 105.0, "cell": 3}
    faults = {"classes_present": {"in_country": False}, "flagged": {"in_country": None}, "within_box": {"lat": 30.0}, "has_cell": {"cell": None}, "dup_resolved": {"physical_known": False}, "levels_observed": {"levels": None}}
    check(spark, schema, sound, S.osm_points((8.0, 102.0, 23.7, 110.0), 1), faults)
    assert statuses(spark, tuple(sound.values()), schema, S.osm_points((8, 102, 23.7, 110), 1), tuple(sound.values()))["object_once"] == "FAIL"
    check(spark, "n_fuel long, want long", {"n_fuel": 4, "want": 4}, S.osm_layers({"n_fuel": "want"}), {"n_fuel_sum": {"want": 5}})
    schema = "m_A double, lane_A double, seen_A double, road_access double, road_len double, road_bridge double"
    sound = {"m_A": 5.0, "lane_A": 10.0, "seen_A": 6.0, "road_access": 5.0, "road_len": 5.0, "road_bridge": 0.0}
    check(spark, schema, sound, S.osm_roads(["A"]), {"non_negative": {"seen_A": -1.0}, "tiers_sum_to_access": {"road_access": 6.0}, "len_le_access": {"road_len": 9.0}, "bridge_le_access": {"road_bridge": 9.0}, "lane_invariants": {"lane_A": 4.0}, "lanes_observed": {"seen_A": 1.0}})
    assert statuses(spark, (100, 3), "n long, n_without long", S.supply_access()) == {"supply_has_access": "FAIL", "supply_access_is_whole": "WARN"}
    assert statuses(spark, (200, 3), "n long, n_without long", S.supply_access()) == {"supply_has_access": "PASS", "supply_access_is_whole": "WARN"}
    check(spark, "recall double, bias double", {"recall": 0.5, "bias": 1.5}, S.recall(), {"recall": {"recall": 0.1}, "bias": {"bias": 3.0}})


def test_land_crawl_and_communes(spark):
    check(spark, "cell long, buildable boolean, built double, frac_water double, pop double", {"cell": 1, "buildable": True, "built": 0.5, "frac_water": 0.0, "pop": 5.0}, S.land_use(), {"buildable_not_null": {"buildable": None}, "fractions_in_range": {"built": 1.5}, "has_buildable": {"buildable": False}, "threshold_is_sane": {"buildable": False}})
    check(spark, "pop double, road_access double", {"pop": 5.0, "road_access": 1.0}, S.road_coverage(), {"pop_without_road": {"road_access": None}})
    schema = "code string, has_series boolean, has_file boolean, flags string, rows_then long, rows_now long"
    sound = {"code": "a", "has_series": True, "has_file": True, "flags": "", "rows_then": 5, "rows_now": 5}
    faults = {"not_empty": {"code": None}, "series_has_file": {"has_file": False}, "file_has_row": {"code": None}, "file_is_declared": {"has_series": False}, "no_snapshot_drift": {"rows_now": None}, "sparse": {"flags": "DUP_TS;SPARSE"}, "dup_ts": {"flags": "DUP_TS;SPARSE"}}
    check(spark, schema, sound, S.crawl_master(), faults)
    assert statuses(spark, tuple(sound.values()), schema, S.crawl_master(), tuple(sound.values()))["code_unique"] == "FAIL"
    schema = "code int, province int, valid boolean, people double, area_km2 double, lat double, lng double, offshore boolean"
    sound = {"code": 1, "province": 1, "valid": True, "people": 100.0, "area_km2": 10.0, "lat": 21.0, "lng": 105.0, "offshore": False}
    faults = {"count": {}, "code_unique": {"code": None}, "geometry_valid": {"valid": None}, "province_count": {"province": None}, "people_plausible": {"people": 1000.0}, "area_plausible": {"area_km2": 1.0}, "centres_in_box": {"lat": 40.0}, "people_positive": {"people": 0.0}}
    faults.pop("count")
    gates = S.communes(1, 1, (50.0, 150.0), (5.0, 15.0), (8.0, 102.0, 23.7, 110.0))
    check(spark, schema, sound, gates, faults)
    assert statuses(spark, tuple(sound.values()), schema, gates, (2, 1, True, 1.0, 1.0, 21.0, 105.0, False))["count"] == "FAIL"


def test_boundary_and_snapshot(spark):
    box = lambda x0, y0, x1, y1: [np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)]
    how = dict(inside={"home": (21.5, 105.5)}, outside={"abroad": (21.5, 107.5)}, used=20, missing=1, provinces=34, area=(11_000.0, 12_500.0))
    land = [box(105, 21, 106, 22), box(106.5, 21, 106.6, 21.1)]
    run = lambda polygons=land, **more: {g: s for g, s, _ in S.boundary(polygons, **{**how, **more})}
    assert set(run().values()) == {"PASS"}
    assert run([])["valid"] == "FAIL"
    assert run(area=(1.0, 2.0))["area_km2"] == "FAIL"
    assert run([box(105, 21, 106, 22), box(107, 21, 108, 22)], area=(0.0, 1e9))["mainland_share"] == "FAIL"
    assert run(inside={"lost": (10.0, 105.5)})["anchor_points"] == "FAIL"
    assert run(outside={"inside": (21.5, 105.5)})["anchor_points"] == "FAIL"
    assert run(missing=5)["ways_resolved"] == "WARN"
    assert run(provinces=3)["provinces_assembled"] == "WARN"
    from hexsite.sources.sinks import verify_manifest

    want = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "path string, size long, sha256 string")
    assert S.snapshot(verify_manifest(want, want)).first()["status"] == "PASS"
    assert S.snapshot(verify_manifest(want.filter("path = 'a'"), want)).first()["status"] == "FAIL"


def test_rollup_equality(spark):
    check(spark, "a long, b long", {"a": 4, "b": 4}, S.rollup_equality({"a": "b"}), {"a_reproduces": {"b": 5}})
    assert statuses(spark, (None, 4), "a long, b long", S.rollup_equality({"a": "b"}))["a_reproduces"] == "FAIL"
    with pytest.raises(G.GateFailed, match="a_reproduces"):
        G.enforce(G.evaluate(spark.createDataFrame([(1, 2)], "a long, b long"), S.rollup_equality({"a": "b"})))

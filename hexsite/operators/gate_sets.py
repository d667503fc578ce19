"""The sets of quality gates, each a list over a table whose columns are named in its docstring.

A set is evaluated in one aggregate (``gates.evaluate``); a value that can't be computed fails. Gates over several tables
take what the others say as columns of one, or as a table of one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexsite.config import DEFAULT, Thresholds
from hexsite.functions import grid
from hexsite.functions.columns import truth
from hexsite.functions.geo import coordinates_valid
from hexsite.operators import admin
from hexsite.operators.gates import Gate, none_where, unique
from hexsite.operators.supply import EXCLUSIONS

EPS = 1e-6


def _c(name: str) -> Column:
    return F.col(name)


def _has(flag: str) -> Column:
    return truth(F.array_contains("flags", flag))


def _sum_if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(truth(condition), value)), F.lit(0.0))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def dedup(t: Thresholds = DEFAULT, group: str = "group") -> list[Gate]:
    """id, physical, is_primary, ``group`` (null: alone), method, n_members (rows of the group), flags."""
    dup = ~truth("is_primary")
    return [
        none_where("reconcile", _c("is_primary").isNull()),
        Gate("physical_id_unique", (F.count_if(truth("is_primary")) - F.count_distinct(F.when(truth("is_primary"), _c("physical")))).cast("double"), most=0.0),
        Gate("no_over_merge", F.coalesce(F.max(F.when(truth(_c("method") == "coord_name"), _c("n_members"))), F.lit(0)).cast("double"), most=float(t.stack_min - 1)),
        none_where("primary_is_self", truth("is_primary") & ~_c("physical").eqNullSafe(_c("id"))),
        none_where("dup_labeled", dup & (_c(group).isNull() | ~_has("CROSS_SOURCE_DUP"))),
    ]


def coords() -> list[Gate]:
    """coord_src, lat_raw, lng_raw, lat, lng, coord_resolved, cell, flags."""
    resolved, placeholder = truth("coord_resolved"), _has("COORD_PLACEHOLDER")
    return [
        none_where("provenance_complete", _c("coord_src").isNull() | _c("lat_raw").isNull() | _c("lng_raw").isNull()),
        none_where("unresolved_no_cell", ~resolved & _c("cell").isNotNull()),
        none_where("no_unfixed_placeholder_in_supply", resolved & placeholder & ~truth(_c("coord_src") == "official")),
        none_where("placeholder_labeled", placeholder & ~truth(_c("coord_src").isin("placeholder", "official"))),
        none_where("cell_consistent", resolved & coordinates_valid("lat", "lng") & ~_c("cell").eqNullSafe(grid.cell_of("lat", "lng"))),
    ]


def config(t: Thresholds = DEFAULT) -> list[Gate]:
    """config_src, config_resolved, n_guns_installed, live_guns, witness, nameplate_kw, site_kw, current_type, flags, is_operational, in_supply."""
    resolved, unknown = truth("config_resolved"), truth(_c("config_src") == "UNKNOWN")
    installed = _c("n_guns_installed")
    parts = resolved.cast("int") + truth(_c("config_src") == "TELEMETRY_BOUND").cast("int") + unknown.cast("int")
    return [
        none_where("guns_ge_observed_max", installed.isNotNull() & (installed < F.coalesce("witness", F.lit(0)))),
        none_where("no_silent_zero", truth("is_operational") & resolved & (F.coalesce(installed, F.lit(0)) == 0)),
        none_where("reporting_le_installed", resolved & (F.coalesce("live_guns", F.lit(0)) > installed)),
        none_where("asset_layer_complete", resolved & (installed.isNull() | _c("site_kw").isNull() | _c("nameplate_kw").isNull() | _c("current_type").isNull())),
        none_where("site_power_le_nameplate", _c("site_kw") > _c("nameplate_kw") + EPS),
        none_where("unknown_is_explicit", unknown & (~_has("UNKNOWN") | installed.isNotNull() | _c("site_kw").isNotNull() | _c("current_type").isNotNull())),
        none_where("row_reconciliation", parts != 1),
        Gate("config_resolved_rate", F.coalesce(F.avg(F.when(truth("in_supply"), resolved.cast("double"))), F.lit(1.0)), least=t.resolved_rate),
    ]


def admin_stations() -> list[Gate]:
    """coord_resolved, commune, known (whether its province is of the one vintage), verdict, cell, in_supply."""
    resolved, labelled, bad = truth("coord_resolved"), _c("commune").isNotNull(), truth(_c("verdict") == "COORD_BAD")
    return [
        Gate("admin_join_rate", F.coalesce(F.avg(F.when(resolved, labelled.cast("double"))), F.lit(0.0)), least=0.995),
        none_where("admin_iff_coord_resolved", labelled != resolved),
        none_where("admin_vintage_single", labelled & ~truth("known")),
        none_where("outside_admin_excluded", bad & (resolved | _c("cell").isNotNull())),
        none_where("supply_fully_labelled", truth("in_supply") & ~labelled),
    ]


def crosswalk(no_province: list[str], expected: int, t: Thresholds = DEFAULT) -> list[Gate]:
    """province, label, purity, status, of a crosswalk: codes that are no provinces may be ambiguous."""
    ok = truth(_c("status") == "OK")
    none = F.count_if(ok) == 0
    return [
        Gate("crosswalk_total", F.when(none, None).otherwise(F.count_distinct(F.when(ok, _c("label"))) + F.when(F.min(F.when(ok, _c("purity"))) < t.crosswalk_purity, expected + 1).otherwise(0)).cast("double"), most=float(expected)),
        none_where("ambiguous_codes_are_nonprovince", ~ok & ~truth(_c("province").isin(no_province))),
    ]


def admin_grid() -> list[Gate]:
    """Of each cell: pop, given (what its weights hand out), joined (touches a commune), centred (its centre does), w (sum of
    weights), label_share and max_share."""
    joined = truth("joined")
    here = _sum_if(joined, _c("pop"))
    return [
        Gate("conservation", F.abs(_total(_c("given")) - here) / F.greatest(F.lit(1.0), F.abs(here)), most=1e-9),
        Gate("join_rate", _sum_if(~joined, _c("pop")) / F.greatest(_total(_c("pop")), F.lit(1.0)), most=5e-3),
        Gate("hex_beats_centroid", (F.count_if(joined) - F.count_if(truth("centred"))).cast("double"), least=1.0),
        Gate("weights_sum_to_one", F.coalesce(F.max(F.abs(_c("w") - 1)), F.lit(0.0)), most=1e-9),
        none_where("label_is_argmax", _c("label_share") < _c("max_share") - 1e-12),
    ]


def commune_rollup(provinces: int) -> list[Gate]:
    """commune, province, n_cells, landless (may have no cell)."""
    return [
        none_where("communes_covered", (F.coalesce("n_cells", F.lit(0)) == 0) & ~truth("landless")),
        Gate("vintage_single", F.abs(F.count_distinct("province") - provinces).cast("double"), most=0.0),
    ]


def rollup_equality(pairs: dict[str, str], tolerance: float = 1e-9) -> list[Gate]:
    """Derived columns reproduce their source: null only where that is null, numbers within the tolerance of its size."""
    out = []
    for derived, source in pairs.items():
        a, b = _c(derived).cast("double"), _c(source).cast("double")
        out.append(none_where(f"{derived}_reproduces", (a.isNull() != b.isNull()) | (F.abs(a - b) > tolerance * F.greatest(F.lit(1.0), F.abs(b)))))
    return out


def supply_export() -> list[Gate]:
    """id, in_supply, reason, lat, lng, cell."""
    supply, out = truth("in_supply"), ~truth("in_supply")
    return [
        none_where("reconciles_input", _c("in_supply").isNull()),
        none_where("every_excluded_has_reason", out & F.coalesce(_c("reason") == "", F.lit(True))),
        none_where("reasons_are_known", _c("reason").isNotNull() & ~_c("reason").isin(list(EXCLUSIONS))),
        unique("pk_unique", "id", "in_supply"),
        Gate("sets_are_disjoint", (F.count_distinct(F.when(supply, _c("id"))) + F.count_distinct(F.when(out, _c("id"))) - F.count_distinct("id")).cast("double"), most=0.0),
        none_where("supply_has_geometry", supply & (_c("lat").isNull() | _c("lng").isNull() | _c("cell").isNull())),
    ]


def covered(in_area: int) -> list[Gate]:
    """id, cell, baseline, operational, coord_resolved, of the stations of an area."""
    base = truth("baseline")
    return [
        none_where("subset_of_supply", base & ~truth("coord_resolved")),
        none_where("cell_not_null", base & _c("cell").isNull()),
        Gate("pk_unique", (F.count_if(base) - F.count_distinct(F.when(base, _c("id")))).cast("double"), most=0.0),
        none_where("operational_subset_of_baseline", truth("operational") & ~base),
        Gate("reconciles_area", F.count_if(base).cast("double"), most=float(in_area)),
    ]


def candidates(p_hint: int, most: int, radius_km: float, t: Thresholds = DEFAULT) -> list[Gate]:
    """One row: share (of core demand that all candidates cover), n (candidates), ratio (distinct coverage sets)."""
    return [
        Gate("upper_bound_coverage", F.max("share"), least=t.coverage_min),
        Gate("freedom_ratio", F.max("n").cast("double"), least=5.0 * p_hint),
        Gate("size_ceiling", F.max("n").cast("double"), most=float(most)),
        Gate("anti_degenerate", F.max("ratio"), least=0.90),
        Gate("grid_radius", F.max(F.lit(float(radius_km))), least=float(np.nextafter(grid.SPACING, 2))),
    ]


def demand(measures: list[str]) -> list[Gate]:
    """cell, kept, cell_state, pop, pop_adj, road_len, road_access, road_bridge, near, far, access_tier, and the ``measures``."""
    kept, road = truth("kept"), _c("road_access")
    lost = F.lit(0.0)
    for m in measures:
        lost = F.greatest(lost, F.abs(_total(_c(m)) - _sum_if(kept, _c(m)) - _sum_if(~kept, _c(m))) / F.greatest(F.lit(1.0), F.abs(_total(_c(m)))))
    negative = F.lit(False)
    for m in measures:
        negative = negative | truth(_c(m) < 0)
    tier = _c("access_tier")
    return [
        Gate("reconcile", lost, most=1e-9),
        Gate("unique_cell", (F.count_if(kept) - F.count_distinct(F.when(kept, _c("cell")))).cast("double"), most=0.0),
        none_where("non_negative", kept & negative),
        none_where("road_len_le_access", kept & (_c("road_len") > road + EPS)),
        none_where("road_bridge_le_access", kept & (_c("road_bridge") > road + EPS)),
        Gate("clip_pop_loss_negligible", _sum_if(~kept, _c("pop")) / F.greatest(_total(_c("pop")), F.lit(1.0)), most=float(np.nextafter(1e-3, 0))),
        none_where("no_outside_cell_in_grid", kept & (_c("cell_state") == "OUTSIDE")),
        none_where("access_tier_consistent", kept & (((road > 0) & (tier != "DIRECT")) | ((tier == "ISOLATED") & ((_c("near") > 0) | (_c("far") > 0))))),
        Gate("no_pop_left_isolated", _sum_if(kept & (tier == "ISOLATED"), _c("pop_adj")) / F.greatest(_sum_if(kept, _c("pop_adj")), F.lit(1.0)), most=float(np.nextafter(1e-4, 0)), warn=True),
    ]


def _accounts(before: Column, after: Column, cut: Column) -> list[Gate]:
    return [
        Gate("retotal_only_reduces", cut, least=-EPS),
        Gate("global_mass_accounted", F.abs(after - (before - cut)), most=float(np.nextafter(1.0, 0))),
        Gate("national_drift_lt_1pct", F.abs(after - before) / F.greatest(before, F.lit(1.0)), most=float(np.nextafter(0.01, 0))),
    ]


def dasymetric(t: Thresholds = DEFAULT) -> list[Gate]:
    """pop, pop_before, largest, bad, commune, pop_new, pop_src, of ``demand.retotal``."""
    cut = _sum_if(_c("pop_src") == "RETOTALED_DANSO", _c("pop")) - _sum_if(_c("pop_src") == "RETOTALED_DANSO", _c("pop_new"))
    return [
        Gate("pop_invariant", F.coalesce(F.max(F.abs(_c("pop") - F.coalesce("pop_before", F.lit(0.0)))), F.lit(0.0)), most=EPS),
        none_where("no_unflagged_implausible_pixel", (_c("largest") > t.pixel_max) & ~truth("bad")),
        Gate("flagged_mass_share", _sum_if(truth("bad"), _c("pop")) / F.greatest(_total(_c("pop")), F.lit(1.0)), most=float(np.nextafter(0.01, 0))),
        *_accounts(_total(_c("pop")), _total(_c("pop_new")), cut),
        Gate("commune_join_coverage", _sum_if(_c("commune").isNull(), _c("pop")) / F.greatest(_total(_c("pop")), F.lit(1.0)), most=float(np.nextafter(0.01, 0)), warn=True),
    ]


def roadless() -> list[Gate]:
    """pop, pop_before, before and pop_new (adjusted population before and after), cut (what the census took off, once a
    row of the commune's sum or 0), access_tier, pop_src, of ``demand.reallocate``."""
    off_road = ~truth(_c("access_tier") == "DIRECT")
    before, after, left = _total(_c("before")), _total(_c("pop_new")), _sum_if(off_road, _c("pop_new"))
    return [
        Gate("pop_invariant", F.coalesce(F.max(F.abs(_c("pop") - _c("pop_before"))), F.lit(0.0)), most=1e-9),
        none_where("no_unlabelled_roadless_pop", off_road & (_c("pop_new") > 0) & ~truth(_c("pop_src").startswith("UNREPAIRED"))),
        *_accounts(before, after, _total(_c("cut"))),
        Gate("roadless_mass_decreases", _sum_if(off_road, _c("before")) - left, least=float(np.nextafter(0, 1))),
        none_where("received_mass_is_direct", off_road & (_c("pop_new") - F.coalesce("before", F.lit(0.0)) > EPS)),
        Gate("ranking_shift", F.count_if(F.abs(_c("pop_new") - _c("before")) > EPS).cast("double"), least=0.0, warn=True),
    ]


def raster(total: float, tolerance: float = 1e-4, ratio_std: float = 1e-6) -> list[Gate]:
    """One row: total, rho (rank correlation with the table before), same_cells, ratio_std (of pixels with another calibration)."""
    return [
        Gate("total_matches", F.abs(F.max("total") - total) / total, most=tolerance),
        Gate("rank_invariant", F.max(F.when(truth("same_cells"), _c("rho")).otherwise(F.lit(-1.0))), least=1 - 1e-12),
        Gate("ratio_is_constant", F.max("ratio_std"), most=ratio_std),
    ]


def osm_points(box: tuple[float, float, float, float], classes: int) -> list[Gate]:
    """poi, class, in_country, is_primary, physical_known (its primary is in the table), levels, lat, lng, cell."""
    lat0, lng0, lat1, lng1 = box
    home = truth("in_country") & truth("is_primary")
    return [
        Gate("classes_present", F.count_distinct(F.when(home, _c("class"))).cast("double"), least=float(classes)),
        none_where("flagged", _c("in_country").isNull()),
        none_where("within_box", ~(_c("lat").between(lat0 - 0.05, lat1 + 0.05) & _c("lng").between(lng0 - 0.05, lng1 + 0.05)), warn=True),
        none_where("has_cell", _c("cell").isNull(), warn=True),
        unique("object_once", "poi"),
        none_where("dup_resolved", ~truth("physical_known") | _c("is_primary").isNull()),
        Gate("levels_observed", F.coalesce(F.avg(F.when(home & (_c("class") == "APARTMENT"), _c("levels").isNotNull().cast("double"))), F.lit(0.0)), least=0.25, warn=True),
    ]


def osm_layers(want: dict[str, str]) -> list[Gate]:
    """Sums of the layers' columns are what the points say: columns n_... of cells against columns of one row, repeated."""
    return [Gate(f"{layer}_sum", F.abs(_total(_c(layer).cast("double")) - F.max(points)), most=0.0) for layer, points in want.items()]


def osm_roads(tiers: list[str]) -> list[Gate]:
    """Of each cell m_T, lane_T and seen_T (metres, lane metres, observed lane metres) for each tier, road_access, road_len, road_bridge."""
    metres = sum((_c(f"m_{t}") for t in tiers), F.lit(0.0))
    negative, lanes = F.lit(False), F.lit(False)
    for t in tiers:
        negative = negative | (F.least(_c(f"m_{t}"), _c(f"lane_{t}"), _c(f"seen_{t}")) < 0)
        lanes = lanes | (_c(f"lane_{t}") + EPS < _c(f"m_{t}")) | (_c(f"seen_{t}") > _c(f"lane_{t}") + EPS)
    seen, all_ = (_total(sum((_c(f"{k}_{t}") for t in tiers), F.lit(0.0))) for k in ("seen", "lane"))
    return [
        none_where("non_negative", negative),
        Gate("tiers_sum_to_access", F.coalesce(F.max(F.abs(_c("road_access") - metres)), F.lit(0.0)), most=EPS),
        none_where("len_le_access", _c("road_len") > _c("road_access") + EPS),
        none_where("bridge_le_access", _c("road_bridge") > _c("road_access") + EPS),
        none_where("lane_invariants", lanes),
        Gate("lanes_observed", F.coalesce(F.try_divide(seen, all_), F.lit(0.0)), least=0.40, warn=True),
    ]


def supply_access(warn_over: float = 0.01, fail_over: float = 0.02) -> list[Gate]:
    """One row: n (supply cells) and n_without (those without a road); a little is a warning, more fails."""
    share = F.coalesce(F.try_divide(F.max("n_without"), F.max("n")), F.lit(0.0))
    return [Gate("supply_has_access", share, most=fail_over), Gate("supply_access_is_whole", share, most=warn_over, warn=True)]


def recall(least: float = 0.30, most_bias: float = 2.0) -> list[Gate]:
    """One row: recall of a class over all strata, and bias, high over low."""
    return [Gate("recall", F.max("recall"), least=least, warn=True), Gate("bias", F.coalesce(F.max("bias"), F.lit(1.0)), most=most_bias, warn=True)]


def land_use() -> list[Gate]:
    """cell, buildable, built, frac_water, pop."""
    people = truth(_c("pop") > 0)
    return [
        none_where("buildable_not_null", _c("buildable").isNull()),
        unique("cell_unique", "cell"),
        none_where("fractions_in_range", ~truth(_c("built").between(0, 1)) | ~truth(_c("frac_water").between(0, 1))),
        Gate("has_buildable", F.count_if(truth("buildable")).cast("double"), least=1.0),
        Gate("threshold_is_sane", F.coalesce(F.avg(F.when(people, (~truth("buildable")).cast("double"))), F.lit(0.0)), most=0.70, warn=True),
    ]


def road_coverage(most: float = 0.20) -> list[Gate]:
    """pop, road_access: share of populated cells without a road."""
    return [Gate("pop_without_road", F.coalesce(F.avg(F.when(truth(_c("pop") > 0), (~truth(_c("road_access") > 0)).cast("double"))), F.lit(0.0)), most=most)]


CRAWL_FLAGS = ["DUP_TS", "NONMONOTONIC", "NEG_VALUE", "NONNUMERIC", "COORD_INVALID", "ALL_ZERO", "SPARSE"]


def crawl_master() -> list[Gate]:
    """Master rows and series files, joined in full on the code: code (null: a file without a row), has_series (what the master
    says), has_file, flags (text, by ;), rows_then and rows_now (of the snapshot and of today)."""
    return [
        unique("code_unique", "code"),
        Gate("not_empty", F.count("code").cast("double"), least=1.0),
        none_where("series_has_file", truth("has_series") & ~truth("has_file")),
        none_where("file_has_row", truth("has_file") & _c("code").isNull()),
        none_where("file_is_declared", truth("has_file") & _c("code").isNotNull() & ~truth("has_series")),
        none_where("no_snapshot_drift", _c("rows_then").isNotNull() & ~_c("rows_then").eqNullSafe(_c("rows_now"))),
        *[none_where(f.lower(), truth(F.array_contains(F.split("flags", ";"), f)), warn=True) for f in CRAWL_FLAGS],
    ]


def communes(expected: int, provinces: int, people: tuple[float, float], land_km2: tuple[float, float], box: tuple[float, float, float, float]) -> list[Gate]:
    """code, province, valid (its geometry), people, area_km2, lat, lng, offshore."""
    lat0, lng0, lat1, lng1 = box
    near = lambda v, low, high: F.when(_total(_c(v)).between(low, high), 0.0).otherwise(1.0)
    return [
        Gate("count", F.abs(F.count(F.lit(1)) - expected).cast("double"), most=0.0),
        Gate("code_unique", (F.count(F.lit(1)) - F.count_distinct("code")).cast("double"), most=0.0),
        none_where("geometry_valid", ~truth("valid")),
        Gate("province_count", F.abs(F.count_distinct("province") - provinces).cast("double"), most=0.0),
        Gate("people_plausible", near("people", *people), most=0.0),
        Gate("area_plausible", near("area_km2", *land_km2), most=0.0),
        none_where("centres_in_box", truth("valid") & ~truth("offshore") & ~(_c("lat").between(lat0, lat1) & _c("lng").between(lng0, lng1))),
        none_where("people_positive", ~truth("offshore") & ~truth(_c("people") > 0), warn=True),
    ]


def boundary(polygons: list[list[np.ndarray]], *, inside: dict[str, tuple[float, float]], outside: dict[str, tuple[float, float]], used: int, missing: int, provinces: int, area: tuple[float, float], least_provinces: int = 30) -> list[tuple[str, str, float]]:
    """(gate, status, value) of one country's polygons: on the driver, as it is one geometry. Anchors are (lat, lng) by name."""

    def row(name: str, value: float, good: bool, warn: bool = False) -> tuple[str, str, float]:
        return name, "PASS" if good else "WARN" if warn else "FAIL", float(value)

    size = [admin.equal_area_km2([p]) for p in polygons]
    if not polygons or min(size) <= 0:
        return [row("valid", 0, False)]
    at = lambda points: admin.contains(polygons, np.array([p[1] for p in points.values()]), np.array([p[0] for p in points.values()]))
    wrong = int((~at(inside)).sum()) + int(at(outside).sum())
    lost = missing / max(used + missing, 1)
    return [
        row("valid", len(polygons), True),
        row("area_km2", sum(size), area[0] <= sum(size) <= area[1]),
        row("mainland_share", max(size) / sum(size), max(size) / sum(size) >= 0.9),
        row("anchor_points", wrong, wrong == 0),
        row("ways_resolved", lost, lost <= 0.05, warn=True),
        row("provinces_assembled", provinces, provinces >= least_provinces, warn=True),
    ]


def snapshot(differences: DataFrame, gate: str = "snapshot") -> DataFrame:
    """One row: how many files of ``sinks.verify_manifest`` are missing, unexpected or different."""
    n = F.count(F.lit(1))
    return differences.agg(F.lit(gate).alias("gate"), F.when(n == 0, "PASS").otherwise("FAIL").alias("status"), n.cast("double").alias("value"), F.lit(0.0).alias("limit"))


__all__ = ["admin_grid", "admin_stations", "boundary", "candidates", "commune_rollup", "communes", "config", "coords", "covered", "crawl_master", "crosswalk", "dasymetric", "dedup", "demand", "land_use", "osm_layers", "osm_points", "osm_roads", "raster", "recall", "road_coverage", "roadless", "rollup_equality", "snapshot", "supply_access", "supply_export"]

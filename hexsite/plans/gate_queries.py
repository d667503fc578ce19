"""The sets of quality gates over tables with known faults: a query a set.

A table's text is the same for both engines; what the gates say of it is written once as library gates and once as SQL.
Some gates of each set fail, or warn, so that a gate that always passes would show.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.operators import gate_sets as S
from hexsite.operators import gates as G
from hexsite.plans.catalogue import query
from hexsite.plans.projections import PROJECTIONS, oracle, view

CELL = grid.cell_sql("lat", "lng")


def _table(spark, sf_dir, text: str):
    """The text over the projections that it names; a text column ``flags`` becomes a list."""
    used = [n for n in PROJECTIONS if re.search(rf"\bFROM {n}\b", text)]
    for n in used:
        text = re.sub(rf"\bFROM {n}\b", f"FROM {{{n}}}", text)
    df = spark.sql(text, **{n: view(spark, sf_dir, n) for n in used})
    return df.withColumn("flags", F.split("flags", ";")) if dict(df.dtypes).get("flags") == "string" else df


def _report(df, gates):
    return G.evaluate(df, gates).select("gate", "status", F.round("value", 6).alias("value"), F.round("limit", 6).alias("limit"))


def _sql(table: str, *rows: tuple) -> str:
    """Rows of (gate, value, '<=' or '>=', limit, and 'WARN' where it only warns) as a report over ``t``, the table."""
    parts = []
    for gate, value, op, limit, *warn in rows:
        bad = "WARN" if warn else "FAIL"
        parts.append(f"SELECT '{gate}' AS gate, CASE WHEN v {op} {limit} THEN 'PASS' ELSE '{bad}' END AS status, round(v, 6) AS value, round(CAST({limit} AS DOUBLE), 6) AS \"limit\" FROM (SELECT CAST({value} AS DOUBLE) AS v FROM t)")
    return f"WITH t AS ({table}) " + " UNION ALL ".join(parts)


def _gates(name: str, table: str, gates, *rows: tuple) -> None:
    @query(name, oracle(_sql(table, *rows)))
    def run(spark, sf_dir):
        return _report(_table(spark, sf_dir, table), gates())


_FLAG = "coalesce(list_contains(string_split(flags, ';'), '{0}'), false)"

_gates(
    "gates_dedup",
    """SELECT site_id AS id, CASE WHEN site_id % 50 = 3 THEN site_id - 1 WHEN site_id % 10 = 1 THEN site_id - 1 ELSE site_id END AS physical, site_id % 10 <> 1 AS is_primary,
       CASE WHEN site_id % 10 < 2 AND site_id % 70 <> 1 THEN site_id - site_id % 10 END AS grp0, 'coord_name' AS method,
       site_id % 6 AS n_members, CASE WHEN site_id % 10 = 1 THEN 'X;CROSS_SOURCE_DUP' ELSE 'X' END AS flags FROM sites""",
    lambda: S.dedup(group="grp0"),
    ("reconcile", "count_if(is_primary IS NULL)", "<=", 0),
    ("physical_id_unique", "count_if(is_primary) - count(DISTINCT CASE WHEN is_primary THEN physical END)", "<=", 0),
    ("no_over_merge", "max(CASE WHEN method = 'coord_name' THEN n_members END)", "<=", 4),
    ("primary_is_self", "count_if(is_primary AND physical IS DISTINCT FROM id)", "<=", 0),
    ("dup_labeled", f"count_if(NOT is_primary AND (grp0 IS NULL OR NOT {_FLAG.format('CROSS_SOURCE_DUP')}))", "<=", 0),
)

_gates(
    "gates_coords",
    f"""SELECT CASE WHEN site_id % 97 = 5 THEN NULL WHEN site_id % 23 = 0 THEN 'placeholder' ELSE 'evcs' END AS coord_src, lat AS lat_raw, lng AS lng_raw, lat, lng, site_id % 23 <> 0 AS coord_resolved,
       CASE WHEN site_id % 23 = 0 THEN NULL WHEN site_id % 211 = 7 THEN 5 ELSE {CELL} END AS cell, CASE WHEN site_id % 23 = 0 OR site_id % 300 = 8 THEN 'COORD_PLACEHOLDER' ELSE '' END AS flags FROM sites""",
    lambda: S.coords(),
    ("provenance_complete", "count_if(coord_src IS NULL)", "<=", 0),
    ("unresolved_no_cell", "count_if(NOT coord_resolved AND cell IS NOT NULL)", "<=", 0),
    ("no_unfixed_placeholder_in_supply", "count_if(coord_resolved AND flags = 'COORD_PLACEHOLDER' AND coalesce(coord_src <> 'official', true))", "<=", 0),
    ("placeholder_labeled", "count_if(flags = 'COORD_PLACEHOLDER' AND coalesce(coord_src NOT IN ('placeholder', 'official'), true))", "<=", 0),
    ("cell_consistent", f"count_if(coord_resolved AND cell IS DISTINCT FROM {CELL})", "<=", 0),
)

_gates(
    "gates_config",
    """SELECT site_id AS id, CASE site_id % 5 WHEN 0 THEN 'OFFICIAL' WHEN 1 THEN 'EVCS_LIVE' WHEN 2 THEN 'TELEMETRY_BOUND' WHEN 3 THEN 'UNKNOWN' ELSE 'OFFICIAL' END AS config_src, site_id % 5 IN (0, 1, 4) AS config_resolved,
       CASE WHEN site_id % 5 = 3 THEN NULL ELSE site_id % 7 END AS n_guns_installed, site_id % 7 AS live_guns, CASE WHEN site_id % 5 = 3 THEN 0 ELSE site_id % 8 - 1 END AS witness, 60e0 AS nameplate_kw, CASE WHEN site_id % 5 = 3 THEN NULL WHEN site_id % 90 = 0 THEN 61e0 ELSE 60e0 END AS site_kw,
       CASE WHEN site_id % 5 = 3 OR site_id % 33 = 0 THEN NULL ELSE 'DC' END AS current_type, CASE WHEN site_id % 5 = 3 THEN 'UNKNOWN' ELSE '' END AS flags, site_id % 2 = 0 AS is_operational, site_id % 3 = 0 AS in_supply FROM sites""",
    lambda: S.config(),
    ("guns_ge_observed_max", "count_if(n_guns_installed < witness)", "<=", 0),
    ("no_silent_zero", "count_if(is_operational AND config_resolved AND n_guns_installed = 0)", "<=", 0),
    ("reporting_le_installed", "count_if(config_resolved AND live_guns > n_guns_installed)", "<=", 0),
    ("asset_layer_complete", "count_if(config_resolved AND current_type IS NULL)", "<=", 0),
    ("site_power_le_nameplate", "count_if(site_kw > nameplate_kw + 1e-6)", "<=", 0),
    ("unknown_is_explicit", "count_if(config_src = 'UNKNOWN' AND (flags <> 'UNKNOWN' OR n_guns_installed IS NOT NULL OR site_kw IS NOT NULL OR current_type IS NOT NULL))", "<=", 0),
    ("row_reconciliation", "count(*) - count_if(config_resolved) - count_if(config_src IN ('TELEMETRY_BOUND', 'UNKNOWN'))", "<=", 0),
    ("config_resolved_rate", "avg(CASE WHEN in_supply THEN CAST(config_resolved AS INT) END)", ">=", "0.985e0"),
)

_gates(
    "gates_admin_stations",
    """SELECT site_id % 23 <> 0 AND site_id % 50 <> 9 AS coord_resolved, CASE WHEN site_id % 23 <> 0 AND site_id % 400 <> 77 THEN province END AS commune, province < 24 AS known,
       CASE WHEN site_id % 50 = 9 THEN 'COORD_BAD' ELSE 'NOT_FLAGGED' END AS verdict, CASE WHEN site_id % 100 <> 9 THEN site_id END AS cell, site_id % 3 = 0 AS in_supply FROM sites""",
    lambda: S.admin_stations(),
    ("admin_join_rate", "avg(CASE WHEN coord_resolved THEN CAST(commune IS NOT NULL AS INT) END)", ">=", "0.995e0"),
    ("admin_iff_coord_resolved", "count_if((commune IS NOT NULL) <> coord_resolved)", "<=", 0),
    ("admin_vintage_single", "count_if(commune IS NOT NULL AND NOT known)", "<=", 0),
    ("outside_admin_excluded", "count_if(verdict = 'COORD_BAD' AND (coord_resolved OR cell IS NOT NULL))", "<=", 0),
    ("supply_fully_labelled", "count_if(in_supply AND commune IS NULL)", "<=", 0),
)

_gates(
    "gates_crosswalk",
    """SELECT concat('P', CAST(province AS VARCHAR(9))) AS province, province % 20 AS label, 0.85e0 + CAST(province % 10 AS DOUBLE) / 60e0 AS purity, CASE WHEN province % 10 >= 3 THEN 'OK' ELSE 'AMBIGUOUS' END AS status FROM provinces""",
    lambda: S.crosswalk(["P0", "P1", "P2", "P10"], 15),
    ("crosswalk_total", "count(DISTINCT CASE WHEN status = 'OK' THEN label END) + CASE WHEN min(CASE WHEN status = 'OK' THEN purity END) < 0.9e0 THEN 16 ELSE 0 END", "<=", 15),
    ("ambiguous_codes_are_nonprovince", "count_if(status <> 'OK' AND province NOT IN ('P0', 'P1', 'P2', 'P10'))", "<=", 0),
)

_CELLS = f"SELECT {CELL} AS cell, sum(pop) AS pop, max(pop) AS largest, count(*) AS n FROM pixels GROUP BY 1"

_gates(
    "gates_admin_grid",
    f"""SELECT cell, pop, CASE WHEN cell % 50 = 0 THEN 0e0 WHEN cell % 77 = 0 THEN pop * 0.9e0 ELSE pop END AS given, cell % 50 <> 0 AS joined, cell % 3 = 0 AND cell % 50 <> 0 AS centred,
       CASE WHEN cell % 77 = 0 THEN 0.9e0 ELSE 1e0 END AS w, CAST(cell % 10 AS DOUBLE) / 10e0 AS label_share, CASE WHEN cell % 60 = 1 THEN 0.95e0 ELSE CAST(cell % 10 AS DOUBLE) / 10e0 END AS max_share FROM ({_CELLS}) c""",
    lambda: S.admin_grid(),
    ("conservation", "abs(sum(given) - sum(CASE WHEN joined THEN pop END)) / greatest(1e0, abs(sum(CASE WHEN joined THEN pop END)))", "<=", "1e-9"),
    ("join_rate", "sum(CASE WHEN NOT joined THEN pop ELSE 0 END) / greatest(sum(pop), 1e0)", "<=", "5e-3"),
    ("hex_beats_centroid", "count_if(joined) - count_if(centred)", ">=", 1),
    ("weights_sum_to_one", "max(abs(w - 1e0))", "<=", "1e-9"),
    ("label_is_argmax", "count_if(label_share < max_share - 1e-12)", "<=", 0),
)

_gates(
    "gates_commune_rollup",
    "SELECT province AS commune, province % 5 AS province, CASE WHEN province % 6 = 0 THEN NULL ELSE province END AS n_cells, province % 12 = 0 AS landless FROM provinces",
    lambda: S.commune_rollup(5),
    ("communes_covered", "count_if(coalesce(n_cells, 0) = 0 AND NOT landless)", "<=", 0),
    ("vintage_single", "abs(count(DISTINCT province) - 5)", "<=", 0),
)

_gates(
    "gates_live_rollup",
    """SELECT station, sum(n) AS n_guns, CASE WHEN station % 100 = 0 THEN sum(n) + 1 ELSE sum(n) END AS n_guns_now, max(kw) AS max_kw, CASE WHEN station % 300 = 0 THEN NULL ELSE max(kw) END AS max_kw_now,
       sum(kw * n) AS total_kw, sum(kw * n) * (1e0 + 1e-12) AS total_kw_now FROM guns GROUP BY station""",
    lambda: S.rollup_equality({"n_guns": "n_guns_now", "max_kw": "max_kw_now", "total_kw": "total_kw_now"}),
    ("n_guns_reproduces", "count_if(n_guns <> n_guns_now)", "<=", 0),
    ("max_kw_reproduces", "count_if((max_kw IS NULL) <> (max_kw_now IS NULL))", "<=", 0),
    ("total_kw_reproduces", "count_if(abs(total_kw - total_kw_now) > 1e-9 * greatest(1e0, abs(total_kw_now)))", "<=", 0),
)

_gates(
    "gates_supply_export",
    f"""SELECT CASE WHEN site_id % 500 = 499 THEN site_id - 1 ELSE site_id END AS id, site_id % 3 <> 0 AS in_supply, CASE WHEN site_id % 3 = 0 THEN CASE WHEN site_id % 90 = 0 THEN '' WHEN site_id % 60 = 3 THEN 'NEW_REASON' ELSE 'RESTRICTED' END END AS reason,
       CASE WHEN site_id % 200 = 1 THEN NULL ELSE lat END AS lat, lng, {CELL} AS cell FROM sites""",
    lambda: S.supply_export(),
    ("reconciles_input", "count_if(in_supply IS NULL)", "<=", 0),
    ("every_excluded_has_reason", "count_if(NOT in_supply AND coalesce(reason, '') = '')", "<=", 0),
    ("reasons_are_known", "count_if(reason NOT IN ('CROSS_SOURCE_DUP', 'ACCESS_UNKNOWN', 'OUT_OF_SERVICE', 'COORD_OUTSIDE_ADMIN', 'COORD_PLACEHOLDER', 'RESTRICTED'))", "<=", 0),
    ("pk_unique", "count(*) - count(DISTINCT (id, in_supply))", "<=", 0),
    ("sets_are_disjoint", "count(DISTINCT CASE WHEN in_supply THEN id END) + count(DISTINCT CASE WHEN NOT in_supply THEN id END) - count(DISTINCT id)", "<=", 0),
    ("supply_has_geometry", "count_if(in_supply AND (lat IS NULL OR lng IS NULL OR cell IS NULL))", "<=", 0),
)

_gates(
    "gates_covered",
    f"""SELECT site_id AS id, CASE WHEN site_id % 40 = 2 THEN NULL ELSE {CELL} END AS cell, site_id % 4 <> 0 AS baseline, site_id % 5 = 0 AS operational, site_id % 23 <> 0 AS coord_resolved FROM sites""",
    lambda: S.covered(10_000_000),
    ("subset_of_supply", "count_if(baseline AND NOT coord_resolved)", "<=", 0),
    ("cell_not_null", "count_if(baseline AND cell IS NULL)", "<=", 0),
    ("pk_unique", "count_if(baseline) - count(DISTINCT CASE WHEN baseline THEN id END)", "<=", 0),
    ("operational_subset_of_baseline", "count_if(operational AND NOT baseline)", "<=", 0),
    ("reconciles_area", "count_if(baseline)", "<=", 10_000_000),
)

_gates(
    "gates_candidates",
    "SELECT count(*) AS n, sum(CASE WHEN site_id % 20 <> 0 THEN 1e0 ELSE 0e0 END) / count(*) AS share, CAST(count(DISTINCT province) AS DOUBLE) / count(*) AS ratio FROM sites",
    lambda: S.candidates(20, 3000, 3.0),
    ("upper_bound_coverage", "max(share)", ">=", "0.9e0"),
    ("freedom_ratio", "max(n)", ">=", 100),
    ("size_ceiling", "max(n)", "<=", 3000),
    ("anti_degenerate", "max(ratio)", ">=", "0.9e0"),
    ("grid_radius", "3e0", ">=", "0.98e0"),
)

_gates(
    "gates_demand",
    f"""SELECT cell, cell % 40 <> 0 AS kept, CASE WHEN cell % 80 = 0 OR cell % 333 = 5 THEN 'OUTSIDE' ELSE 'INSIDE' END AS cell_state, pop, CASE WHEN cell % 97 = 1 THEN -1e0 ELSE pop END AS pop_adj, CAST(cell % 5 AS DOUBLE) * 10e0 AS road_len,
       CAST(cell % 7 AS DOUBLE) * 10e0 AS road_access, CAST(cell % 3 AS DOUBLE) AS road_bridge, CAST(cell % 2 AS DOUBLE) AS near, 0e0 AS far,
       CASE WHEN cell % 7 > 0 AND cell % 200 <> 9 THEN 'DIRECT' WHEN cell % 2 = 1 THEN 'ADJACENT' ELSE 'ISOLATED' END AS access_tier FROM ({_CELLS}) c""",
    lambda: S.demand(["pop", "pop_adj", "road_len", "road_access"]),
    ("reconcile", "greatest(abs(sum(pop) - sum(CASE WHEN kept THEN pop ELSE 0 END) - sum(CASE WHEN NOT kept THEN pop ELSE 0 END)) / greatest(1e0, abs(sum(pop))), 0e0)", "<=", "1e-9"),
    ("unique_cell", "count_if(kept) - count(DISTINCT CASE WHEN kept THEN cell END)", "<=", 0),
    ("non_negative", "count_if(kept AND (pop < 0 OR pop_adj < 0 OR road_len < 0 OR road_access < 0))", "<=", 0),
    ("road_len_le_access", "count_if(kept AND road_len > road_access + 1e-6)", "<=", 0),
    ("road_bridge_le_access", "count_if(kept AND road_bridge > road_access + 1e-6)", "<=", 0),
    ("clip_pop_loss_negligible", "sum(CASE WHEN NOT kept THEN pop ELSE 0 END) / greatest(sum(pop), 1e0)", "<=", "1e-3"),
    ("no_outside_cell_in_grid", "count_if(kept AND cell_state = 'OUTSIDE')", "<=", 0),
    ("access_tier_consistent", "count_if(kept AND ((road_access > 0 AND access_tier <> 'DIRECT') OR (access_tier = 'ISOLATED' AND (near > 0 OR far > 0))))", "<=", 0),
    ("no_pop_left_isolated", "sum(CASE WHEN kept AND access_tier = 'ISOLATED' THEN pop_adj ELSE 0 END) / greatest(sum(CASE WHEN kept THEN pop_adj ELSE 0 END), 1e0)", "<=", "1e-4", "WARN"),
)

_ACCOUNTS = lambda before, after, cut: (
    ("retotal_only_reduces", cut, ">=", "-1e-6"),
    ("global_mass_accounted", f"abs({after} - ({before} - ({cut})))", "<=", "0.999999999e0"),
    ("national_drift_lt_1pct", f"abs({after} - {before}) / greatest({before}, 1e0)", "<=", "0.00999999999e0"),
)


_gates(
    "gates_dasymetric",
    f"""SELECT pop, CASE WHEN cell % 701 = 3 THEN pop + 1e0 ELSE pop END AS pop_before, largest * 4e0 AS largest, largest * 4e0 > 1100e0 AS bad, CASE WHEN cell % 30 = 0 THEN NULL ELSE cell % 9 END AS commune,
       CASE WHEN cell % 9 = 1 THEN pop * 0.9e0 WHEN cell % 500 = 2 THEN pop + 3e0 ELSE pop END AS pop_new, CASE WHEN cell % 9 = 1 THEN 'RETOTALED_DANSO' ELSE 'WORLDPOP' END AS pop_src FROM ({_CELLS}) c""",
    lambda: S.dasymetric(),
    ("pop_invariant", "max(abs(pop - pop_before))", "<=", "1e-6"),
    ("no_unflagged_implausible_pixel", "count_if(largest > 1000e0 AND NOT bad)", "<=", 0),
    ("flagged_mass_share", "coalesce(sum(CASE WHEN bad THEN pop END), 0) / greatest(sum(pop), 1e0)", "<=", "0.00999999999e0"),
    *_ACCOUNTS("sum(pop)", "sum(pop_new)", "sum(CASE WHEN pop_src = 'RETOTALED_DANSO' THEN pop - pop_new ELSE 0 END)"),
    ("commune_join_coverage", "sum(CASE WHEN commune IS NULL THEN pop ELSE 0 END) / greatest(sum(pop), 1e0)", "<=", "0.00999999999e0", "WARN"),
)

_gates(
    "gates_roadless",
    f"""SELECT pop, pop AS pop_before, pop AS before, CASE WHEN cell % 4 = 0 AND cell % 40 <> 0 THEN 0e0 WHEN cell % 300 = 4 THEN pop + 2e0 ELSE pop END AS pop_new, CASE WHEN cell % 4 = 0 AND cell % 40 <> 0 THEN pop ELSE 0e0 END AS cut,
       CASE WHEN cell % 4 = 0 OR cell % 300 = 5 THEN 'NEAR' ELSE 'DIRECT' END AS access_tier, CASE WHEN cell % 40 = 0 THEN 'UNREPAIRED_NO_COMMUNE' WHEN cell % 4 = 0 THEN 'MOVED_TO_ACCESSIBLE' ELSE 'WORLDPOP' END AS pop_src FROM ({_CELLS}) c""",
    lambda: S.roadless(),
    ("pop_invariant", "max(abs(pop - pop_before))", "<=", "1e-9"),
    ("no_unlabelled_roadless_pop", "count_if(access_tier <> 'DIRECT' AND pop_new > 0 AND NOT starts_with(pop_src, 'UNREPAIRED'))", "<=", 0),
    *_ACCOUNTS("sum(before)", "sum(pop_new)", "sum(cut)"),
    ("roadless_mass_decreases", "sum(CASE WHEN access_tier <> 'DIRECT' THEN before ELSE 0 END) - sum(CASE WHEN access_tier <> 'DIRECT' THEN pop_new ELSE 0 END)", ">=", "1e-12"),
    ("received_mass_is_direct", "count_if(access_tier <> 'DIRECT' AND pop_new - before > 1e-6)", "<=", 0),
    ("ranking_shift", "count_if(abs(pop_new - before) > 1e-6)", ">=", 0, "WARN"),
)

_gates(
    "gates_raster",
    "SELECT CAST(count(*) AS DOUBLE) * 1.0002e0 AS total, 1e0 - 1e-13 AS rho, count(DISTINCT pixel) = count(*) AS same_cells, 0.5e0 AS ratio_std FROM pixels",
    lambda: S.raster(1000.0, 1e6, 1.0),
    ("total_matches", "abs(max(total) - 1000e0) / 1000e0", "<=", 1000000),
    ("rank_invariant", "max(CASE WHEN same_cells THEN rho ELSE -1e0 END)", ">=", "(1e0 - 1e-12)"),
    ("ratio_is_constant", "max(ratio_std)", "<=", 1),
)

_gates(
    "gates_osm_points",
    f"""SELECT poi, class, poi % 31 <> 0 AS in_country, CASE WHEN poi % 600 = 7 THEN NULL ELSE poi % 7 <> 0 END AS is_primary, poi % 90 <> 0 AS physical_known, CASE WHEN poi % 9 < 7 THEN NULL ELSE levels END AS levels,
       lat + CASE WHEN poi % 99 = 1 THEN 9e0 ELSE 0e0 END AS lat, lng, CASE WHEN poi % 80 = 5 THEN NULL ELSE {CELL} END AS cell FROM poi""",
    lambda: S.osm_points((8.0, 102.0, 23.7, 110.0), 7),
    ("classes_present", "count(DISTINCT CASE WHEN in_country AND is_primary THEN class END)", ">=", 7),
    ("flagged", "count_if(in_country IS NULL)", "<=", 0),
    ("within_box", "count_if(NOT (lat BETWEEN 7.95e0 AND 23.75e0 AND lng BETWEEN 101.95e0 AND 110.05e0))", "<=", 0, "WARN"),
    ("has_cell", "count_if(cell IS NULL)", "<=", 0, "WARN"),
    ("object_once", "count(*) - count(DISTINCT poi)", "<=", 0),
    ("dup_resolved", "count_if(NOT physical_known OR is_primary IS NULL)", "<=", 0),
    ("levels_observed", "coalesce(avg(CASE WHEN in_country AND is_primary AND class = 'APARTMENT' THEN CAST(levels IS NOT NULL AS INT) END), 0)", ">=", "0.25e0", "WARN"),
)

_gates(
    "gates_osm_layers",
    f"""SELECT c.cell, c.n_fuel, c.n_mall, (SELECT count(*) FROM poi WHERE class = 'FUEL') AS all_fuel, (SELECT count(*) FROM poi WHERE class = 'MALL' AND poi % 50 <> 0) + 1 AS all_mall
        FROM (SELECT {CELL} AS cell, count_if(class = 'FUEL') AS n_fuel, count_if(class = 'MALL') AS n_mall FROM poi GROUP BY 1) c""",
    lambda: S.osm_layers({"n_fuel": "all_fuel", "n_mall": "all_mall"}),
    ("n_fuel_sum", "abs(sum(n_fuel) - max(all_fuel))", "<=", 0),
    ("n_mall_sum", "abs(sum(n_mall) - max(all_mall))", "<=", 0),
)

_gates(
    "gates_osm_roads",
    f"""SELECT cell, CAST(cell % 9 AS DOUBLE) AS m_MOTORWAY, CAST(cell % 9 AS DOUBLE) * 2e0 AS lane_MOTORWAY, CAST(cell % 3 AS DOUBLE) AS seen_MOTORWAY, CAST(cell % 4 AS DOUBLE) AS m_LOCAL, CASE WHEN cell % 90 = 3 THEN 0e0 ELSE CAST(cell % 4 AS DOUBLE) END AS lane_LOCAL, 0e0 AS seen_LOCAL,
       CAST(cell % 9 + cell % 4 AS DOUBLE) + CASE WHEN cell % 70 = 0 THEN 1e-3 ELSE 0e0 END AS road_access, CAST(cell % 9 AS DOUBLE) AS road_len, CASE WHEN cell % 100 = 0 THEN 50e0 ELSE 0e0 END AS road_bridge FROM ({_CELLS}) c""",
    lambda: S.osm_roads(["MOTORWAY", "LOCAL"]),
    ("non_negative", "count_if(m_MOTORWAY < 0 OR lane_MOTORWAY < 0 OR seen_MOTORWAY < 0 OR m_LOCAL < 0 OR lane_LOCAL < 0 OR seen_LOCAL < 0)", "<=", 0),
    ("tiers_sum_to_access", "max(abs(road_access - m_MOTORWAY - m_LOCAL))", "<=", "1e-6"),
    ("len_le_access", "count_if(road_len > road_access + 1e-6)", "<=", 0),
    ("bridge_le_access", "count_if(road_bridge > road_access + 1e-6)", "<=", 0),
    ("lane_invariants", "count_if(lane_MOTORWAY + 1e-6 < m_MOTORWAY OR seen_MOTORWAY > lane_MOTORWAY + 1e-6 OR lane_LOCAL + 1e-6 < m_LOCAL OR seen_LOCAL > lane_LOCAL + 1e-6)", "<=", 0),
    ("lanes_observed", "sum(seen_MOTORWAY + seen_LOCAL) / sum(lane_MOTORWAY + lane_LOCAL)", ">=", "0.4e0", "WARN"),
)

_gates(
    "gates_osm_supply",
    "SELECT count(*) AS n, count_if(site_id % 70 = 0) AS n_without FROM sites",
    lambda: S.supply_access(),
    ("supply_has_access", "max(n_without) * 1e0 / max(n)", "<=", "0.02e0"),
    ("supply_access_is_whole", "max(n_without) * 1e0 / max(n)", "<=", "0.01e0", "WARN"),
)

_gates(
    "gates_osm_recall",
    "SELECT avg(CASE WHEN site_id % 4 = 0 THEN 1e0 ELSE 0e0 END) AS recall, 2.5e0 AS bias FROM sites",
    lambda: S.recall(),
    ("recall", "max(recall)", ">=", "0.3e0", "WARN"),
    ("bias", "max(bias)", "<=", 2, "WARN"),
)

_gates(
    "gates_land_use",
    f"SELECT cell, CASE WHEN cell % 500 = 1 THEN NULL ELSE cell % 5 = 0 END AS buildable, CAST(cell % 11 AS DOUBLE) / 10e0 AS built, CASE WHEN cell % 200 = 3 THEN 1.2e0 ELSE 0.1e0 END AS frac_water, pop FROM ({_CELLS}) c",
    lambda: S.land_use(),
    ("buildable_not_null", "count_if(buildable IS NULL)", "<=", 0),
    ("cell_unique", "count(*) - count(DISTINCT cell)", "<=", 0),
    ("fractions_in_range", "count_if(NOT (built BETWEEN 0 AND 1) OR NOT (frac_water BETWEEN 0 AND 1))", "<=", 0),
    ("has_buildable", "count_if(buildable)", ">=", 1),
    ("threshold_is_sane", "avg(CASE WHEN pop > 0 THEN CAST(NOT coalesce(buildable, false) AS INT) END)", "<=", "0.7e0", "WARN"),
)

_gates(
    "gates_road_coverage",
    f"SELECT pop, CASE WHEN cell % 4 = 0 THEN NULL ELSE 5e0 END AS road_access FROM ({_CELLS}) c",
    lambda: S.road_coverage(),
    ("pop_without_road", "avg(CASE WHEN pop > 0 THEN CAST(coalesce(road_access, 0) <= 0 AS INT) END)", "<=", "0.2e0"),
)

_MASTER = """SELECT CASE WHEN site_id % 300 = 1 THEN NULL ELSE code END AS code, site_id % 4 <> 0 AS has_series, site_id % 4 <> 0 OR site_id % 100 = 0 AS has_file, CASE site_id % 9 WHEN 0 THEN 'DUP_TS;SPARSE' WHEN 1 THEN 'NEG_VALUE' ELSE '' END AS quality,
  site_id % 50 AS rows_then, CASE WHEN site_id % 77 = 0 THEN 0 ELSE site_id % 50 END AS rows_now FROM sites"""


@query(
    "gates_crawl_master",
    oracle(
        _sql(
            _MASTER,
            ("code_unique", "count(*) - count(DISTINCT code) - CASE WHEN count_if(code IS NULL) > 0 THEN 1 ELSE 0 END", "<=", 0),
            ("not_empty", "count(code)", ">=", 1),
            ("series_has_file", "count_if(has_series AND NOT has_file)", "<=", 0),
            ("file_has_row", "count_if(has_file AND code IS NULL)", "<=", 0),
            ("file_is_declared", "count_if(has_file AND code IS NOT NULL AND NOT has_series)", "<=", 0),
            ("no_snapshot_drift", "count_if(rows_then <> rows_now)", "<=", 0),
            *[(f.lower(), f"count_if(list_contains(string_split(quality, ';'), '{f}'))", "<=", 0, "WARN") for f in ("DUP_TS", "NONMONOTONIC", "NEG_VALUE", "NONNUMERIC", "COORD_INVALID", "ALL_ZERO", "SPARSE")],
        )
    ),
)
def crawl_master(spark, sf_dir):
    """Files without a row of the master, rows whose file nobody declared, and a snapshot that drifted."""
    return _report(_table(spark, sf_dir, _MASTER).withColumnRenamed("quality", "flags"), S.crawl_master())


_gates(
    "gates_communes",
    """SELECT CASE WHEN province = 9 THEN 8 ELSE province END AS code, province % 5 AS province, province <> 3 AS valid, CASE WHEN province % 8 = 0 THEN 0e0 ELSE 4e6 END AS people, 13000e0 + CAST(province AS DOUBLE) AS area_km2,
       CASE WHEN province = 4 THEN 40e0 ELSE lat0 END AS lat, lng0 AS lng, province = 16 AS offshore FROM provinces""",
    lambda: S.communes(25, 5, (95e6, 120e6), (320e3, 360e3), (8.0, 102.0, 23.7, 110.0)),
    ("count", "abs(count(*) - 25)", "<=", 0),
    ("code_unique", "count(*) - count(DISTINCT code)", "<=", 0),
    ("geometry_valid", "count_if(NOT valid)", "<=", 0),
    ("province_count", "abs(count(DISTINCT province) - 5)", "<=", 0),
    ("people_plausible", "CASE WHEN sum(people) BETWEEN 95e6 AND 120e6 THEN 0e0 ELSE 1e0 END", "<=", 0),
    ("area_plausible", "CASE WHEN sum(area_km2) BETWEEN 320e3 AND 360e3 THEN 0e0 ELSE 1e0 END", "<=", 0),
    ("centres_in_box", "count_if(valid AND NOT offshore AND NOT (lat BETWEEN 8e0 AND 23.7e0 AND lng BETWEEN 102e0 AND 110e0))", "<=", 0),
    ("people_positive", "count_if(NOT offshore AND people <= 0)", "<=", 0, "WARN"),
)


@query("gates_snapshot", oracle("SELECT 'snapshot' AS gate, 'FAIL' AS status, CAST(count(*) AS DOUBLE) AS value, 0e0 AS \"limit\" FROM (SELECT store FROM registry WHERE store % 5 IN (0, 1, 2))"))
def snapshot(spark, sf_dir):
    """Of five files one is missing, one unexpected and one different."""
    from hexsite.sources.sinks import verify_manifest

    k = F.col("store")
    files = view(spark, sf_dir, "registry").select(F.concat(F.lit("f"), k.cast("string")).alias("path"), k, (k * 10).alias("size"), F.md5(k.cast("string")).alias("sha256"))
    have = files.filter("store % 5 <> 0").withColumn("size", F.when(k % 5 == 2, F.col("size") + 1).otherwise(F.col("size")))
    return S.snapshot(verify_manifest(have.drop("store"), files.filter("store % 5 <> 1").drop("store")))

"""Thresholds of the siting operators, in one place. Fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    lat_min: float = 8.0
    lat_max: float = 23.6
    area_lat_max: float = 23.7  # the national area reaches farther north than the box of valid coordinates
    lng_min: float = 102.0
    lng_max: float = 110.0
    sparse_points: int = 24
    ac_max_kw: float = 25.0
    match_radius_m: float = 250.0
    match_near_m: float = 40.0
    match_name: float = 82.0
    match_verify_m: float = 200.0
    dup_radius_m: float = 50.0
    stack_min: int = 5
    far_km: float = 100.0
    margin_km: float = 75.0
    centroid_min: int = 20
    snap_move_km: float = 0.05
    resolved_rate: float = 0.985
    admin_snap_m: float = 500.0
    crosswalk_min: int = 20
    crosswalk_purity: float = 0.90
    poi_dup_m: float = 30.0
    complex_m: float = 150.0
    road_step_m: float = 150.0
    pixel_max: float = 1000.0
    top3_share: float = 0.8
    cell_pop: float = 2000.0
    census_ratio: float = 0.859
    retotal_ratio: float = 1.5
    dense_per_km2: float = 1500.0
    urban_per_km2: float = 300.0
    dense_total: float = 50_000.0
    urban_total: float = 5_000.0
    water_max: float = 0.50
    water_wet_max: float = 0.70
    built_min: float = 0.05
    crop_min: float = 0.60
    built_low: float = 0.15
    substation_m: float = 50_000.0
    service_km: float = 3.0
    gap_quantile: float = 0.90
    coverage_min: float = 0.90


DEFAULT = Thresholds()
EARTH_KM = 6371.0088
EARTH_M = 6_371_000.0

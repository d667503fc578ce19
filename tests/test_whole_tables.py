"""Queries that read whole tables, against brute force over all of their rows."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexsite.functions import grid
from hexsite.operators import admin
from hexsite.plans import catalogue
from hexsite.plans.projections import view
from hexsite.plans.spatial_queries import cells

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


@pytest.fixture(scope="module")
def near(spark):
    """site_id -> the cells within 3 km, for all sites, and the population of each cell."""
    c = cells(spark, DATA).select("cell", "pop", grid.centre_lat("cell").alias("lat"), grid.centre_lng("cell").alias("lng")).collect()
    a, b = np.radians([r["lat"] for r in c]), np.radians([r["lng"] for r in c])
    out = {}
    for s in view(spark, DATA, "sites").select("site_id", "lat", "lng").collect():
        x, y = math.radians(s["lat"]), math.radians(s["lng"])
        d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.sin((a - x) / 2) ** 2 + math.cos(x) * np.cos(a) * np.sin((b - y) / 2) ** 2))
        out[s["site_id"]] = {c[k]["cell"] for k in np.flatnonzero(d <= 3000)}
    return out, {r["cell"]: r["pop"] for r in c}


def test_coverage_is_of_all_sites(spark, near):
    sets, pop = near
    rows = {r["site_id"]: r["n"] for r in catalogue.queries()["jn29_coverage"](spark, DATA).collect()}
    assert rows == {s: len(c) for s, c in sets.items() if c}
    assert any(s % 10 for s in rows)
    one = catalogue.entry(spark, DATA).first()
    assert one["covered"] == pytest.approx(sum(pop[c] for c in set().union(*sets.values())), abs=1e-4)


def test_greedy_chooses_from_all_sites(spark, near):
    sets, pop = near
    left, want = {s: set(c) for s, c in sets.items()}, []
    for _ in range(5):
        gain = {s: round(sum(pop[c] for c in cs), 6) for s, cs in left.items()}
        best = min(gain, key=lambda s: (-gain[s], s))
        want.append(best)
        left = {s: cs - sets[best] for s, cs in left.items()}
    got = catalogue.queries()["mclp_greedy"](spark, DATA).orderBy("step").collect()
    assert [r["site_id"] for r in got] == want


def test_all_excluded_sites_by_priority(spark):
    rank = ["CROSS_SOURCE_DUP", "ACCESS_UNKNOWN", "OUT_OF_SERVICE", "COORD_PLACEHOLDER", "COORD_OUTSIDE_ADMIN", "RESTRICTED"]
    got = [tuple(r) for r in catalogue.queries()["so2_reason_order"](spark, DATA).collect()]
    every = [tuple(r) for r in catalogue.queries()["flt6_exclusion_reason"](spark, DATA).collect()]
    assert len(got) > 50
    assert got == sorted(every, key=lambda r: (rank.index(r[1]), r[0]))


def test_every_site_is_matched_once(spark):
    codes = [r["code"] for r in catalogue.queries()["c4_match_confidence"](spark, DATA).collect()]
    assert sorted(int(c.lstrip("x")) for c in codes) == sorted(r["site_id"] for r in view(spark, DATA, "sites").select("site_id").collect())


def test_points_on_edges_are_in_no_polygon(spark):
    square, hole = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (2, 1), (2, 2), (1, 2)]
    polygons = spark.createDataFrame([("a", bytearray(admin.wkb([square, hole])))], "name string, geom binary")
    at = [(0, 2), (2, 0), (4, 2), (2, 4), (0, 0), (1, 1.5), (1.5, 2), (0.5, 0.5), (3, 3), (1.5, 1.5)]
    points = spark.createDataFrame([(k, float(y), float(x)) for k, (x, y) in enumerate(at)], "site_id int, lat double, lng double")
    got = {r["site_id"]: r["name"] for r in admin.points_in_polygons(points, "site_id", polygons, "name").collect()}
    assert got == {k: "a" if k in (7, 8) else None for k in range(len(at))}
    slanted = admin.read_wkb(admin.wkb([[(0, 0), (4, 0), (4, 4)]]))
    assert admin.contains(slanted, np.array([2.0, 2.5]), np.array([2.0, 2.0])).tolist() == [False, True]

"""A hexagonal grid as plain arithmetic: cells are numbers, so neighbours are sums and joins are on integers.

Points are projected to x = R cos(phi0) lambda, y = R phi and put in the hexagon, of pointy top, whose centre is
nearest; centres are SPACING apart. A cell is (q + 2**20) * 2**21 + (r + 2**20) of its axial coordinates. No function is
called but floor and abs, so a cell is the same in any engine, and all of it is compiled with the rest of a stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexsite.config import EARTH_KM

SPACING, PHI0 = 0.98, 16.0
AREA_KM2 = math.sqrt(3) / 2 * SPACING**2
KX, KY = EARTH_KM * math.pi / 180 * math.cos(math.radians(PHI0)), EARTH_KM * math.pi / 180
BITS, HALF = 21, 1 << 20
_SIDE = SPACING / math.sqrt(3)
_A, _B, _C = KX * math.sqrt(3) / 3 / _SIDE, KY / 3 / _SIDE, KY * 2 / 3 / _SIDE


def cell_sql(lat: str, lng: str) -> str:
    """Cell of a point; null if a coordinate is."""
    x, z = f"({_A!r}e0 * ({lng}) - {_B!r}e0 * ({lat}))", f"({_C!r}e0 * ({lat}))"
    y = f"(-{x} - {z})"
    rx, ry, rz = (f"floor({v} + 0.5e0)" for v in (x, y, z))
    dx, dy, dz = f"abs({rx} - {x})", f"abs({ry} - {y})", f"abs({rz} - {z})"
    q = f"CASE WHEN {dx} > {dy} AND {dx} > {dz} THEN -{ry} - {rz} ELSE {rx} END"
    r = f"CASE WHEN {dx} > {dy} AND {dx} > {dz} THEN {rz} WHEN {dy} > {dz} THEN {rz} ELSE -{rx} - {ry} END"
    return f"((CAST({q} AS BIGINT) + {HALF}) * {1 << BITS} + (CAST({r} AS BIGINT) + {HALF}))"


def centre_sql(cell: str) -> tuple[str, str]:
    """(lat, lng) of a cell's centre."""
    q, r = f"CAST(({cell} >> {BITS}) - {HALF} AS DOUBLE)", f"CAST(({cell} & {(1 << BITS) - 1}) - {HALF} AS DOUBLE)"
    return f"({SPACING * math.sqrt(3) / 2 / KY!r}e0 * {r})", f"({SPACING / KX!r}e0 * ({q} + {r} / 2e0))"


def cell_of(lat: str, lng: str) -> Column:
    return F.expr(cell_sql(lat, lng))


def centre_lat(cell: str) -> Column:
    return F.expr(centre_sql(cell)[0])


def centre_lng(cell: str) -> Column:
    return F.expr(centre_sql(cell)[1])


def steps(k: int) -> list[int]:
    """What to add to a cell for each cell within k rings, itself included: 1 + 3k(k+1) numbers."""
    return [q * (1 << BITS) + r for q in range(-k, k + 1) for r in range(max(-k, -q - k), min(k, -q + k) + 1)]


def ring(k: int) -> list[int]:
    """Steps to the cells exactly k rings away."""
    return sorted(set(steps(k)) - set(steps(k - 1))) if k else [0]


def disk(cell: str | Column, k: int) -> Column:
    """Array of the cells within k rings."""
    c = F.col(cell) if isinstance(cell, str) else cell
    return F.array(*[c + F.lit(d) for d in steps(k)])


def rings_for(radius_km: float) -> int:
    """Rings that hold every centre within the radius, with one to spare for the projection's stretch."""
    return math.ceil(radius_km / (SPACING * math.sqrt(3) / 2)) + 1


def boundary(cell: int) -> list[tuple[float, float]]:
    """(lat, lng) of the six corners."""
    q, r = (cell >> BITS) - HALF, (cell & (1 << BITS) - 1) - HALF
    x, y = SPACING * (q + r / 2), SPACING * math.sqrt(3) / 2 * r
    corners = [(x + _SIDE * math.sin(math.radians(60 * k)), y + _SIDE * math.cos(math.radians(60 * k))) for k in range(6)]
    return [(b / KY, a / KX) for a, b in corners]

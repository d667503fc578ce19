"""Administrative areas: hexagons over polygons with weights, weighted roll-ups, labels, dissolving, WKB polygons."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexsite.config import EARTH_KM
from hexsite.functions import grid
from hexsite.functions.columns import truth, with_flag

# --- polygons in numpy


def wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    """Little-endian WKB of a polygon of (lng, lat) rings."""
    out = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        r = r if r[0] == r[-1] else [*r, r[0]]
        out += struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes()
    return out


def read_wkb(raw: bytes) -> list[list[np.ndarray]]:
    """Polygons, each a list of rings (points, 2), of a WKB polygon or multipolygon."""

    def one(at: int) -> tuple[list, int]:
        order = "<" if raw[at] else ">"
        kind, n = struct.unpack_from(order + "II", raw, at + 1)
        at += 9
        if kind == 6:
            out = []
            for _ in range(n):
                got, at = one(at)
                out += got
            return out, at
        if kind != 3:
            raise ValueError(f"WKB type {kind}")
        rings = []
        for _ in range(n):
            k = struct.unpack_from(order + "I", raw, at)[0]
            rings.append(np.frombuffer(raw, order + "f8", 2 * k, at + 4).reshape(k, 2))
            at += 4 + 16 * k
        return [rings], at

    return one(0)[0]


def contains(polygons: list[list[np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Strictly within: even-odd rule over all rings, holes and several parts alike; a point on a ring is outside that part.
    Vectorised over the points."""
    inside = np.zeros(len(x), bool)
    for rings in polygons:
        part, edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
        for r in rings:
            for (x0, y0), (x1, y1) in zip(r[:-1], r[1:], strict=True):
                if y0 != y1:
                    cross = ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
                    part ^= cross
                between = (np.minimum(x0, x1) <= x) & (x <= np.maximum(x0, x1)) & (np.minimum(y0, y1) <= y) & (y <= np.maximum(y0, y1))
                edge |= between & ((x1 - x0) * (y - y0) == (y1 - y0) * (x - x0))
        inside |= part & ~edge
    return inside


def area(points: np.ndarray) -> float:
    """Unsigned area of a ring; measured from one of its points, as far from zero the products would lose the area."""
    x, y = (points - points[0]).T
    return 0.5 * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))))


def clip(subject: np.ndarray, convex: np.ndarray) -> np.ndarray:
    """The part of a ring inside a convex ring, one edge after the other."""
    x, y = convex[:, 0], convex[:, 1]
    if np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)) < 0:
        convex = convex[::-1]
    out = [tuple(p) for p in subject]
    for (ax, ay), (bx, by) in zip(convex, np.roll(convex, -1, axis=0), strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        before, out = out, []
        for p, q in zip(before, before[1:] + before[:1], strict=True):
            sp, sq = side(p), side(q)
            if sp >= 0:
                out.append(p)
            if (sp > 0 > sq) or (sp < 0 < sq):
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        if not out:
            return np.zeros((0, 2))
    return np.array(out)


def overlap_share(cell: int, polygons: list[list[np.ndarray]]) -> float:
    """Share of a cell's hexagon inside polygons (outer rings less holes)."""
    hexagon = np.array([(lng, lat) for lat, lng in grid.boundary(cell)])
    total = 0.0
    for rings in polygons:
        for k, r in enumerate(rings):
            part = clip(r[:-1] if (r[0] == r[-1]).all() else r, hexagon)
            if len(part) >= 3:
                total += area(part) * (1 if k == 0 else -1)
    return total / area(hexagon)


def _tile(lat: Column, lng: Column, step: float) -> Column:
    return F.struct(F.floor(lat / step).cast("long").alias("x"), F.floor(lng / step).cast("long").alias("y"))


def with_boxes(polygons: DataFrame, name: str, geometry: str = "geom") -> DataFrame:
    """Bounding boxes of WKB polygons."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            boxes = []
            for raw in batch.column(1).to_pylist():
                p = np.concatenate([r for rings in read_wkb(raw) for r in rings])
                boxes.append((*p.min(axis=0), *p.max(axis=0)))
            lng0, lat0, lng1, lat1 = zip(*boxes, strict=True) if boxes else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, pa.float64()) for v in (lat0, lat1, lng0, lng1)]], names=["name", "geom", "lat0", "lat1", "lng0", "lng1"])

    kind = dict(polygons.dtypes)[name]
    return polygons.select(F.col(name).alias("name"), F.col(geometry).alias("geom")).mapInArrow(run, f"name {kind}, geom binary, lat0 double, lat1 double, lng0 double, lng1 double")


def points_in_polygons(points: DataFrame, key: str, polygons: DataFrame, name: str, *, step: float = 0.25) -> DataFrame:
    """(key, name): the least polygon that holds each point, else null. Candidates meet in tiles; rays are cast by numpy."""
    boxed = with_boxes(polygons, name)
    tiles = lambda lo, hi: F.sequence(F.floor(F.col(lo) / step).cast("long"), F.floor(F.col(hi) / step).cast("long"))
    p = points.select(F.col(key).alias("key"), "lat", "lng", F.floor(F.col("lat") / step).cast("long").alias("x"), F.floor(F.col("lng") / step).cast("long").alias("y"))
    b = boxed.withColumn("x", F.explode(tiles("lat0", "lat1"))).withColumn("y", F.explode(tiles("lng0", "lng1")))
    met = p.join(b, ["x", "y"]).filter(F.col("lat").between(F.col("lat0"), F.col("lat1")) & F.col("lng").between(F.col("lng0"), F.col("lng1"))).select("key", "lat", "lng", "name", "geom")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list] = {}
        for batch in batches:
            t = batch.to_pandas()
            keep = np.zeros(len(t), bool)
            for raw, rows in t.groupby("geom", sort=False).indices.items():
                if len(known) > 200:
                    known.clear()
                if raw not in known:
                    known[raw] = read_wkb(raw)
                keep[rows] = contains(known[raw], t["lng"].to_numpy()[rows], t["lat"].to_numpy()[rows])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(3).filter(pa.array(keep))], names=["key", "name"])

    kinds = dict(points.dtypes)[key], dict(polygons.dtypes)[name]
    first = met.mapInArrow(run, f"key {kinds[0]}, name {kinds[1]}").groupBy("key").agg(F.min("name").alias(name))
    return points.select(key).join(first, F.col(key) == F.col("key") if key != "key" else "key", "left").select(key, name)


def cell_overlaps(cells: DataFrame, polygons: DataFrame, name: str, *, step: float = 0.25) -> DataFrame:
    """(cell, name, area_share, w): positive overlaps of hexagons and polygons; the weights of a cell sum to 1."""
    boxed = with_boxes(polygons, name)
    tiles = lambda lo, hi: F.sequence(F.floor((F.col(lo) - 0.02) / step).cast("long"), F.floor((F.col(hi) + 0.02) / step).cast("long"))
    b = boxed.withColumn("x", F.explode(tiles("lat0", "lat1"))).withColumn("y", F.explode(tiles("lng0", "lng1")))
    c = cells.select("cell", grid.centre_lat("cell").alias("lat"), grid.centre_lng("cell").alias("lng"))
    c = c.withColumn("x", F.floor(F.col("lat") / step).cast("long")).withColumn("y", F.floor(F.col("lng") / step).cast("long"))
    near = F.col("lat").between(F.col("lat0") - 0.02, F.col("lat1") + 0.02) & F.col("lng").between(F.col("lng0") - 0.02, F.col("lng1") + 0.02)
    met = c.join(b, ["x", "y"]).filter(near).select("cell", "name", "geom")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, list] = {}
            share = []
            for cell, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if raw not in known:
                    known[raw] = read_wkb(raw)
                share.append(overlap_share(cell, known[raw]))
            keep = pa.array([s > 1e-9 for s in share])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(share).filter(keep)], names=["cell", "name", "area_share"])

    kind = dict(polygons.dtypes)[name]
    found = met.mapInArrow(run, f"cell long, name {kind}, area_share double")
    total = found.groupBy("cell").agg(F.sum("area_share").alias("_t"))
    return found.join(total, "cell").select("cell", F.col("name").alias(name), "area_share", (F.col("area_share") / F.col("_t")).alias("w"))


def labels(overlaps: DataFrame, name: str) -> DataFrame:
    """The polygon with the largest share of each cell, the least name on a tie, and how many overlap it."""
    return overlaps.groupBy("cell").agg(F.min_by(name, F.struct(-F.col("area_share"), name)).alias(name), F.count(F.lit(1)).alias("n_overlaps"))


def weighted_rollup(overlaps: DataFrame, cells: DataFrame, name: str, measures: list[str], areas: DataFrame) -> DataFrame:
    """Sums of measure x weight over each polygon, and cells; polygons without cells stay, with 0."""
    sums = overlaps.join(cells.select("cell", *measures), "cell").groupBy(name).agg(*[F.sum(F.col(m) * F.col("w")).alias(m) for m in measures], F.count_distinct("cell").alias("n_cells"), F.sum("w").alias("w"))
    return areas.select(name).join(sums, name, "left").fillna(0)


def verdict(resolved: Column, outside: Column, flagged: Column, corroborated: Column) -> Column:
    """What the geometry says of a station's coordinates. In this order: they were never resolved; they lie outside every unit
    and the tolerance, flagged or not; they were flagged and the address confirms the unit; they were flagged; nothing."""
    return F.when(~truth(resolved), "NO_COORD").when(truth(outside), "COORD_BAD").when(truth(flagged), F.when(truth(corroborated), "COORD_CONFIRMED").otherwise("UNRESOLVED")).otherwise("NOT_FLAGGED")


def ruled(df: DataFrame, labels: list[str], *, conflict: Column | None = None) -> DataFrame:
    """The verdict's effects: a bad point is no longer resolved, says so and has no cell; stations whose place is unknown
    have no labels; flags tell which were outside, which were snapped, and whose province differs.

    Reads verdict, method (inside, nearest, none), coord_resolved, cell, coord_src, flags and the ``labels``.
    """
    bad = truth(F.col("verdict") == "COORD_BAD")
    have = F.col("flags")
    for condition, flag in ((bad, "COORD_OUTSIDE_ADMIN"), (truth(F.col("method") == "nearest") & ~bad, "ADMIN_COORD_SNAPPED"), (F.lit(False) if conflict is None else conflict, "ADMIN_PROVINCE_CONFLICT")):
        have = with_flag(have, condition, flag)
    out = df.withColumns({"flags": have, "cell": F.when(~bad, F.col("cell")), "coord_src": F.when(bad, "outside_admin").otherwise(F.col("coord_src")), "coord_resolved": truth("coord_resolved") & ~bad})
    known = F.col("coord_resolved")
    return out.withColumns({**{c: F.when(known, F.col(c)) for c in labels}, "method": F.when(known, F.col("method")).otherwise("unresolved")})


def dissolve(polygons: DataFrame, group: str, geometry: str = "geom", *, digits: int = 9) -> DataFrame:
    """(group, geom, n, area): the union of each group's polygons, and their number.

    For polygons that tile the plane, as administrative units do: an edge that two of them share lies inside the union,
    whichever way each runs along it, so edges are counted, those that stand once are the union's boundary, and they are
    joined to rings. Edges are cut at all corners that lie on them, so neighbours with other corners meet as well. A group's edges come to one task after
    shared ones have been taken out. Rings within rings are holes.
    """
    kind = dict(polygons.dtypes)[group]
    sides = polygons.select(F.col(group).alias("g"), F.col(geometry).alias("geom")).mapInArrow(_sides(digits), f"g {kind}, ax double, ay double, bx double, by double")
    counts = polygons.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    once = sides.groupBy("g", "ax", "ay", "bx", "by").agg(F.count(F.lit(1)).alias("c")).filter("c % 2 = 1").drop("c")
    schema = f"g {kind}, geom binary, area double"

    def run(key, t):
        import pandas as pd

        segments = split_at_corners(t[["ax", "ay", "bx", "by"]].to_numpy())
        rings = rings_of(segments)
        polys = nested(rings)
        return pd.DataFrame({"g": [key[0]], "geom": [multi_wkb(polys)], "area": [sum(area(p[0]) - sum(map(area, p[1:])) for p in polys)]})

    return once.groupBy("g").applyInPandas(run, schema).join(counts, "g").select(F.col("g").alias(group), "geom", "n", "area")


def _sides(digits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts = [], []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for rings in read_wkb(raw):
                    for r in rings:
                        r = np.round(np.asarray(r, float), digits)
                        a, b = r[:-1], r[1:]
                        swap = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
                        low, high = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
                        keep = (low != high).any(axis=1)
                        parts.append(np.concatenate([low, high], axis=1)[keep])
                        names += [name] * int(keep.sum())
            flat = np.concatenate(parts) if parts else np.zeros((0, 4))
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field(0).type), *[pa.array(flat[:, k]) for k in range(4)]], names=["g", "ax", "ay", "bx", "by"])

    return run


def split_at_corners(segments: np.ndarray) -> np.ndarray:
    """Segments (ax, ay, bx, by) cut at every corner of another that lies on them; pieces that then stand twice go."""
    corners = np.unique(segments.reshape(-1, 2), axis=0)
    pieces: dict[tuple, int] = {}
    for ax, ay, bx, by in segments:
        box = corners[(corners[:, 0] >= min(ax, bx)) & (corners[:, 0] <= max(ax, bx)) & (corners[:, 1] >= min(ay, by)) & (corners[:, 1] <= max(ay, by))]
        on = box[np.abs((bx - ax) * (box[:, 1] - ay) - (by - ay) * (box[:, 0] - ax)) <= 1e-12]
        on = on[np.lexsort((on[:, 1], on[:, 0]))]
        for p, q in zip(on[:-1], on[1:], strict=True):
            k = (*p, *q)
            pieces[k] = pieces.get(k, 0) + 1
    return np.array([k for k, c in pieces.items() if c % 2]).reshape(-1, 4)


def rings_of(segments: np.ndarray) -> list[np.ndarray]:
    """Closed rings (points, 2) assembled from segments in any order; lines that close no ring are left out.

    At a corner of several ways the sharpest turn is taken, so rings that touch in a point stay apart.
    """
    ways: dict[tuple, set[tuple]] = {}
    for ax, ay, bx, by in segments:
        ways.setdefault((ax, ay), set()).add((bx, by))
        ways.setdefault((bx, by), set()).add((ax, ay))
    loose = [p for p, q in ways.items() if len(q) == 1]
    while loose:  # ends of lines
        p = loose.pop()
        if len(ways.get(p, ())) == 1:
            q = ways.pop(p).pop()
            ways[q].discard(p)
            if len(ways[q]) == 1:
                loose.append(q)
    rings = []
    for start in sorted(ways):
        while ways[start]:
            path, seen = [start], {start: 0}
            here, came = start, None
            while True:
                if came is None or len(ways[here]) == 1:
                    there = min(ways[here])
                else:
                    back = np.arctan2(came[1] - here[1], came[0] - here[0])
                    there = min(ways[here], key=lambda q: (np.arctan2(q[1] - here[1], q[0] - here[0]) - back) % (2 * np.pi) or 7.0)  # noqa: B023
                ways[here].discard(there)
                ways[there].discard(here)
                came, here = here, there
                if here in seen:
                    ring = path[seen[here] :]
                    if len(ring) >= 3:
                        rings.append(np.array([*ring, here]))
                    for p in path[seen[here] + 1 :]:
                        del seen[p]
                    path = path[: seen[here] + 1]
                    came = path[-2] if len(path) > 1 else None
                    if here == start:
                        break
                    if not ways[here]:
                        break
                else:
                    seen[here] = len(path)
                    path.append(here)
                if not ways[here]:
                    break
    return rings


def nested(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons: each ring that an even number of others hold, with the holes right inside it."""
    order = sorted(rings, key=area, reverse=True)
    held = [[j for j in range(i) if _holds(order[j], r)] for i, r in enumerate(order)]
    out = {i: [order[i]] for i in range(len(order)) if len(held[i]) % 2 == 0}
    for i in range(len(order)):
        if len(held[i]) % 2:
            out[held[i][-1]].append(order[i])
    return list(out.values())


def _holds(outer: np.ndarray, inner: np.ndarray) -> bool:
    middle = (inner[:-1] + inner[1:]) / 2  # corners may touch, so middles of sides decide
    return bool(contains([[outer]], middle[:, 0], middle[:, 1]).mean() > 0.5)


def multi_wkb(polygons: list[list[np.ndarray]]) -> bytes:
    """WKB of a polygon, or of several."""
    parts = [wkb([[tuple(p) for p in r] for r in rings]) for rings in polygons]
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)


def equal_area_km2(polygons: list[list[np.ndarray]], latitude: float = 16.0) -> float:
    """Area of polygons in degrees, by the cylindrical equal-area projection around a parallel; holes are taken off."""
    k = np.cos(np.radians(latitude))
    flat = lambda r: np.stack([EARTH_KM * np.radians(r[:, 0]) * k, EARTH_KM * np.sin(np.radians(r[:, 1])) / k], axis=1)
    return sum(area(flat(rings[0])) - sum(area(flat(r)) for r in rings[1:]) for rings in polygons)


def assembled(ways: list[np.ndarray | None]) -> tuple[list[list[np.ndarray]], int, int]:
    """(polygons, ways used, ways missing) of a boundary given as lines in any order and direction; None is a missing one,
    and what it leaves open is no ring."""
    there = [w for w in ways if w is not None]
    segments = np.concatenate([np.concatenate([w[:-1], w[1:]], axis=1) for w in there]) if there else np.zeros((0, 4))
    swap = (segments[:, 0] > segments[:, 2]) | ((segments[:, 0] == segments[:, 2]) & (segments[:, 1] > segments[:, 3]))
    segments = np.where(swap[:, None], segments[:, [2, 3, 0, 1]], segments)
    return nested(rings_of(np.unique(segments, axis=0))), len(there), len(ways) - len(there)


def largest_outer(rings: list[np.ndarray]) -> np.ndarray | None:
    """Of a relation's outer rings, four points at least, the one of the largest area."""
    closed = [r for r in rings if len(r) >= 4]
    return max(closed, key=area) if closed else None


def mostly_inside(parts: list[list[list[np.ndarray]]], country: list[list[np.ndarray]], least: float = 0.5) -> list[bool]:
    """Which areas (outer ring each) have at least this share inside a country made of convex polygons that don't overlap."""
    out = []
    for polygons in parts:
        whole = sum(area(rings[0]) for rings in polygons)
        inside = 0.0
        for rings in polygons:
            for outer in country:
                part = clip(rings[0][:-1], outer[0][:-1])
                inside += area(part) if len(part) >= 3 else 0.0
        out.append(whole > 0 and inside / whole >= least)
    return out


def built_hectares(pixels: DataFrame, polygons: DataFrame, name: str, *, hectares: float = 0.04) -> DataFrame:
    """(name, cell, built_ha): built-up pixels (pixel, lat, lng) that each polygon holds, by cell, times a pixel's area."""
    at = points_in_polygons(pixels, "pixel", polygons, name).filter(F.col(name).isNotNull())
    cells = pixels.select("pixel", grid.cell_of("lat", "lng").alias("cell"))
    return at.join(cells, "pixel").groupBy(name, "cell").agg((F.count(F.lit(1)) * hectares).alias("built_ha"))

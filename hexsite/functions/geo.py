"""Distances and coordinate predicates as column expressions; each text is valid in Spark and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexsite.config import DEFAULT, EARTH_KM, EARTH_M, Thresholds


def haversine_sql(lat1: str, lng1: str, lat2: str, lng2: str, radius: float = EARTH_M) -> str:
    """Great-circle distance, in the unit of ``radius``; the sine is kept within 1, and a null coordinate gives null
    (``least`` alone would pass over it)."""
    return (
        f"(2e0 * {float(radius)!r}e0 * asin(least(1e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2e0), 2e0) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2e0), 2e0)))) + "
        f"0e0 * ({lat1} + {lng1} + {lat2} + {lng2}))"
    )


def haversine_m(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    return F.expr(haversine_sql(lat1, lng1, lat2, lng2))


def haversine_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    return F.expr(haversine_sql(lat1, lng1, lat2, lng2, EARTH_KM))


def coordinates_valid(lat: str, lng: str, t: Thresholds = DEFAULT) -> Column:
    """Both parse as numbers and lie in the country's box; never null."""
    a, b = F.col(lat).try_cast("double"), F.col(lng).try_cast("double")
    return F.coalesce(a.between(t.lat_min, t.lat_max) & b.between(t.lng_min, t.lng_max), F.lit(False))


class Area:
    """A study area: a circle with a buffer. Predicates are columns."""

    def __init__(self, name: str, lat: float, lng: float, radius_km: float, buffer_km: float = 5.0):
        self.name, self.lat, self.lng, self.radius_km, self.buffer_km = name, lat, lng, radius_km, buffer_km

    def _distance(self, lat: str, lng: str) -> Column:
        return F.expr(haversine_sql(f"{self.lat!r}e0", f"{self.lng!r}e0", lat, lng, EARTH_KM))

    def core(self, lat: str, lng: str) -> Column:
        return F.coalesce(self._distance(lat, lng) <= self.radius_km, F.lit(False))

    def contains(self, lat: str, lng: str) -> Column:
        return F.coalesce(self._distance(lat, lng) <= self.radius_km + self.buffer_km, F.lit(False))

    def box(self) -> tuple[float, float, float, float]:
        """(lat_min, lat_max, lng_min, lng_max) around the buffered circle."""
        import math

        r = self.radius_km + self.buffer_km
        dlat, dlng = r / 111.32, r / (111.32 * math.cos(math.radians(self.lat)))
        return self.lat - dlat, self.lat + dlat, self.lng - dlng, self.lng + dlng


class Country:
    """The national area: the box itself is core and buffer alike."""

    def __init__(self, t: Thresholds = DEFAULT):
        self.t = t

    def contains(self, lat: str, lng: str) -> Column:
        return F.coalesce(F.col(lat).between(self.t.lat_min, self.t.area_lat_max) & F.col(lng).between(self.t.lng_min, self.t.lng_max), F.lit(False))

    core = contains


# Presets of study areas (name, latitude, longitude, radius in km).
PRESETS = {
    "hanoi": Area("hanoi", 21.0278, 105.8342, 25.0),
    "hcm": Area("hcm", 10.7769, 106.7009, 25.0),
    "danang": Area("danang", 16.0544, 108.2022, 20.0),
    "haiphong": Area("haiphong", 20.8449, 106.6881, 20.0),
    "cantho": Area("cantho", 10.0452, 105.7469, 15.0),
}


def resolve_area(city: str | None, **changes) -> Area | Country:
    """A preset, changed as asked; a place that isn't preset needs lat, lng and radius_km; none is the country."""
    if city is None and not changes:
        return Country()
    if city in PRESETS:
        p = PRESETS[city]
        base = {"lat": p.lat, "lng": p.lng, "radius_km": p.radius_km, "buffer_km": p.buffer_km}
    elif {"lat", "lng", "radius_km"} <= changes.keys():
        base = {}
    else:
        raise ValueError(f"{city!r} isn't preset: give lat, lng and radius_km")
    return Area(city or "custom", **{**base, **changes})

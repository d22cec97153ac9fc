"""Distances, geofences and runway lookups as column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdshort import airport

SPHERE_RADIUS_M = 6_371_000.0
HAVERSINE_RADIUS_KM = 6378.0
KM_PER_NAUTICAL_MILE = 1.852
MAX_RADAR_RANGE_KM = 180 * KM_PER_NAUTICAL_MILE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else (c if isinstance(c, Column) else F.lit(float(c)))


def great_circle_m(lat1, lon1, lat2, lon2) -> Column:
    """Spherical law of cosines in metres; the cosine is clamped so that equal points give 0, not NaN."""
    b = F.radians(_col(lat2))
    dlon = F.radians(_col(lon1) - _col(lon2))
    if isinstance(lat1, float):
        sin_a, cos_a = F.lit(math.sin(math.radians(lat1))), F.lit(math.cos(math.radians(lat1)))
    else:
        sin_a, cos_a = F.sin(F.radians(_col(lat1))), F.cos(F.radians(_col(lat1)))
    cosine = sin_a * F.sin(b) + cos_a * F.cos(b) * F.cos(dlon)
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))) * SPHERE_RADIUS_M


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in kilometres; null if any coordinate is null."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.atan2(F.sqrt(h), F.sqrt(1 - h)) * (2 * HAVERSINE_RADIUS_KM)


def within_airport(lat="lat", lon="lon", radius_m: float = airport.CENTRE_RADIUS_M) -> Column:
    return great_circle_m(*airport.CENTRE, lat, lon) <= radius_m


def _near(lat: Column, lon: Column, lat0: float, lon0: float, limit_m: float) -> Column:
    """Cheap box around a point, wider than the circle, tested before any trigonometry."""
    dlat = math.degrees(limit_m / SPHERE_RADIUS_M) * 1.01
    dlon = dlat / math.cos(math.radians(lat0)) * 1.01
    return lat.between(lat0 - dlat, lat0 + dlat) & lon.between(lon0 - dlon, lon0 + dlon)


def holding_point(lat="lat", lon="lon", limit_m: float = 20.0) -> Column:
    """Struct (designator, runway) of the first listed point closer than the limit, else null fields."""
    la, lo = _col(lat), _col(lon)
    hit = F.lit(None).cast("struct<designator:string,runway:string>")
    tests = None
    for name, runway, plon, plat in airport.HOLDING_POINTS:
        cond = _near(la, lo, plat, plon, limit_m) & (great_circle_m(plat, plon, la, lo) < limit_m)
        value = F.struct(F.lit(name).alias("designator"), F.lit(runway).alias("runway"))
        tests = F.when(cond, value) if tests is None else tests.when(cond, value)
    return tests.otherwise(hit)


def in_holding_point(lat="lat", lon="lon", limit_km: float = 0.01) -> Column:
    """True if any holding point is within the limit (haversine)."""
    la, lo = _col(lat), _col(lon)
    # the box is sized with the smaller sphere, so it also covers the haversine circle
    tests = [
        _near(la, lo, plat, plon, limit_km * 1000) & (haversine_km(plat, plon, la, lo) <= limit_km)
        for _, _, plon, plat in airport.HOLDING_POINTS
    ]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def point_in_ring(lat, lon, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule: a ray to the east crosses the ring's edges an odd number of times."""
    la, lo = _col(lat), _col(lon)
    crossings = []
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        spans = (F.lit(y1) > la) != (F.lit(y0) > la)
        at_lat = (la - y1) * (x0 - x1) / (y0 - y1 + 1e-9) + x1
        crossings.append((spans & (lo < at_lat)).cast("int"))
    return F.coalesce(reduce(Column.__add__, crossings) % 2 == 1, F.lit(False))


def runway_at(lat="lat", lon="lon") -> Column:
    """First runway whose rectangle contains the point."""
    tests = None
    for runway, ring in airport.RUNWAY_RINGS.items():
        inside = point_in_ring(lat, lon, ring)
        tests = F.when(inside, runway) if tests is None else tests.when(inside, runway)
    return tests


def nearest_numbered_runway(lat="lat", lon="lon") -> Column:
    """Numbered runway with the smallest squared degree distance; null without a position."""
    la, lo = _col(lat), _col(lon)
    options = F.array(*[
        F.struct(((la - plat) * (la - plat) + (lo - plon) * (lo - plon)).alias("d"), F.lit(name).alias("name"))
        for name, plat, plon in airport.NUMBERED_RUNWAYS
    ])
    return F.when(la.isNotNull() & lo.isNotNull(), F.array_min(options)["name"])


def radar_distance_km(lat="lat", lon="lon") -> Column:
    return haversine_km(*airport.RADAR, lat, lon)


def radar_horizon_km(target_height_km, radar_height_km=0.0) -> Column:
    """Line-of-sight range over a sphere between two heights in kilometres."""
    r = HAVERSINE_RADIUS_KM
    reach = [F.acos(F.lit(r) / (_col(h) + r)) for h in (radar_height_km, target_height_km)]
    return (reach[0] + reach[1]) * r


def valid_airborne_position(lat, lon, height_km) -> Column:
    """Within 180 nautical miles of the radar and above its horizon."""
    d = radar_distance_km(lat, lon)
    return (d <= MAX_RADAR_RANGE_KM) & (d <= radar_horizon_km(height_km))


def knots_to_kmh(speed) -> Column:
    return _col(speed) * KM_PER_NAUTICAL_MILE


def reverse_runway_label(label) -> Column:
    """`14L/32R` <-> `32R/14L`."""
    return F.concat(F.substring(_col(label), -3, 3), F.lit("/"), F.substring(_col(label), 1, 3))


def runway_label(label) -> Column:
    """Bring a runway label in either order to the one the tables use."""
    c = _col(label)
    return F.when(c.isin(airport.RUNWAY_NAMES), c).otherwise(reverse_runway_label(c))

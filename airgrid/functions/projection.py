"""Map projections in closed form as Column arithmetic.

Formulas: Snyder, "Map Projections - A Working Manual", USGS Professional Paper 1395 (1987).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# GRS80 ellipsoid and the authalic spheres of the two raster products.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
WGS84_F = 1 / 298.257223563
SINUSOIDAL_RADIUS = 6371007.181


@dataclass(frozen=True)
class AlbersParams:
    """Conus Albers (EPSG:5072): standard parallels, origin, ellipsoid."""

    lat_1: float = 29.5
    lat_2: float = 45.5
    lat_0: float = 23.0
    lon_0: float = -96.0
    a: float = GRS80_A
    e: float = math.sqrt(2 * GRS80_F - GRS80_F**2)


@dataclass(frozen=True)
class LambertParams:
    """One-parallel conformal conic of the weather grid."""

    lat_0: float = 50.0
    lon_0: float = -107.0
    x_0: float = 5632642.22547
    y_0: float = 4612545.65137
    a: float = GRS80_A
    e: float = math.sqrt(2 * WGS84_F - WGS84_F**2)


def _authalic_q(sin_lat: float, e: float) -> float:
    tail = math.log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e)
    return (1 - e * e) * (sin_lat / (1 - (e * sin_lat) ** 2) - tail)


def _parallel_m(lat: float, e: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)


def albers_constants(p: AlbersParams = AlbersParams()) -> dict[str, float]:
    """Cone constant ``n``, ``C`` and the radius at the origin."""
    one, two, zero = (math.radians(v) for v in (p.lat_1, p.lat_2, p.lat_0))
    m1, m2 = _parallel_m(one, p.e), _parallel_m(two, p.e)
    q1, q2, q0 = (_authalic_q(math.sin(v), p.e) for v in (one, two, zero))
    n = (m1 * m1 - m2 * m2) / (q2 - q1)
    c = m1 * m1 + n * q1
    return {"n": n, "c": c, "rho0": p.a * math.sqrt(c - n * q0) / n}


def albers(lon: Column, lat: Column, p: AlbersParams = AlbersParams()) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to equal-area metres."""
    k = albers_constants(p)
    s = F.sin(F.radians(lat))
    es = s * p.e
    q = (1 - p.e**2) * (s / (1 - es * es) - F.ln((1 - es) / (1 + es)) / (2 * p.e))
    rho = p.a * F.sqrt(k["c"] - k["n"] * q) / k["n"]
    theta = F.radians(lon - p.lon_0) * k["n"]
    return rho * F.sin(theta), k["rho0"] - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, p: AlbersParams = AlbersParams()) -> tuple[Column, Column]:
    """Inverse of :func:`albers`: metres to longitude and latitude (series, then one Newton step)."""
    k = albers_constants(p)
    down = k["rho0"] - y
    rho = F.sqrt(x * x + down * down)
    q = (k["c"] - (rho * k["n"] / p.a) ** 2) / k["n"]
    q_pole = _authalic_q(1.0, p.e)
    beta = F.asin(q / q_pole)
    e2 = p.e**2
    lat = (
        beta
        + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta)
        + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta)
        + (761 * e2**3 / 45360) * F.sin(6 * beta)
    )
    s = F.sin(lat)
    flat = 1 - s * s * e2
    gap = q / (1 - e2) - s / flat + F.ln((1 - s * p.e) / (1 + s * p.e)) / (2 * p.e)
    lat = lat + flat * flat / (F.cos(lat) * 2) * gap
    return F.degrees(F.atan2(x, down) / k["n"]) + p.lon_0, F.degrees(lat)


def _conformal_t(lat: float, e: float) -> float:
    s = e * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (e / 2)


def lambert_constants(p: LambertParams = LambertParams()) -> dict[str, float]:
    """Cone constant, scale factor ``F`` and radius at the origin (one standard parallel)."""
    zero = math.radians(p.lat_0)
    n = math.sin(zero)
    t0 = _conformal_t(zero, p.e)
    big_f = _parallel_m(zero, p.e) / (n * t0**n)
    return {"n": n, "f": big_f, "rho0": p.a * big_f * t0**n}


def lambert(lon: Column, lat: Column, p: LambertParams = LambertParams()) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to the metres of the weather grid."""
    k = lambert_constants(p)
    phi = F.radians(lat)
    es = F.sin(phi) * p.e
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(p.e / 2))
    rho = p.a * k["f"] * F.pow(t, F.lit(k["n"]))
    theta = F.radians(lon - p.lon_0) * k["n"]
    return p.x_0 + rho * F.sin(theta), p.y_0 + k["rho0"] - rho * F.cos(theta)


def ring_albers(ring: Column, p: AlbersParams = AlbersParams()) -> Column:
    """J9 for polygons: an array of corners ``(lon, lat)`` in degrees to corners ``(x, y)``.

    Edges stay straight lines between the projected corners.
    """

    def corner(c: Column) -> Column:
        x, y = albers(c["lon"], c["lat"], p)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, corner)


def sinusoidal(lon: Column, lat: Column, radius: float = SINUSOIDAL_RADIUS) -> tuple[Column, Column]:
    """Longitude and latitude to sinusoidal metres (the forward of J11)."""
    phi = F.radians(lat)
    return F.radians(lon) * F.cos(phi) * radius, phi * radius


def sinusoidal_inverse(
    x: Column, y: Column, radius: float = SINUSOIDAL_RADIUS
) -> tuple[Column, Column]:
    """Sinusoidal metres to longitude and latitude; beyond the poles gives NULL."""
    phi = y / radius
    inside = F.abs(phi) < math.pi / 2
    lon = F.degrees(F.try_divide(x, F.cos(phi) * radius))
    return F.when(inside, lon), F.when(inside, F.degrees(phi))

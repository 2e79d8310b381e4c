"""Planar and geodetic expressions as Columns. Rings and lines are array<struct<x double, y double>>."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the projected system: GRS 80, UTM zone 18 north.
RADIUS, FLATTENING = 6378137.0, 1 / 298.257222101
MERIDIAN, SCALE, FALSE_EAST = -75.0, 0.9996, 500000.0
_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_INVERSE = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_ECCENTRICITY = 2 * math.sqrt(_N) / (1 + _N)


def to_metres(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to east and north, by Krueger's series to the third order of n."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(MERIDIAN))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_ECCENTRICITY) * F.atanh(F.lit(_ECCENTRICITY) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for k, a in enumerate(_FORWARD, 1):
        east = east + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        north = north + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return FALSE_EAST + SCALE * _RECTIFYING * east, SCALE * _RECTIFYING * north


def to_degrees(east: Column, north: Column) -> tuple[Column, Column]:
    """East and north to degrees."""
    xi, eta = north / (SCALE * _RECTIFYING), (east - FALSE_EAST) / (SCALE * _RECTIFYING)
    u, v = xi, eta
    for k, b in enumerate(_INVERSE, 1):
        u = u - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        v = v - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    lat = chi
    for k, c in enumerate(_LATITUDE, 1):
        lat = lat + c * F.sin(2 * k * chi)
    return MERIDIAN + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(lat)


def rounded(c: Column, decimals: int = 6) -> Column:
    return F.rint(c * 10**decimals) / 10**decimals


def rounded_ring(ring: Column, decimals: int = 6) -> Column:
    return F.transform(ring, lambda p: F.struct(rounded(p["x"], decimals).alias("x"), rounded(p["y"], decimals).alias("y")))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column, clockwise: bool = False) -> Column:
    """A closed rectangle, counter-clockwise unless asked."""
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    corners = [at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0)]
    return F.array(*(corners[::-1] if clockwise else corners))


def signed_area(ring: Column) -> Column:
    """Positive for a counter-clockwise ring."""
    pairs = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]) / 2


def counter_clockwise(ring: Column) -> Column:
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def line_length(line: Column) -> Column:
    pairs = F.arrays_zip(F.slice(line, 1, F.size(line) - 1).alias("a"), F.slice(line, 2, F.size(line) - 1).alias("b"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.hypot(p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"]))


def crosses_ray(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether the ray from (x, y) to the east crosses the edge (half-open in y)."""
    return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)


def on_edge(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    level = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
    return level & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))


def side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))

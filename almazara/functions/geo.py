"""Geometry without native libraries: projections and well-known binary."""

from __future__ import annotations

import math
import struct

import numpy as np

# The GRS80 ellipsoid and the scale of transverse Mercator zones.
AXIS, FLATTENING, SCALE = 6_378_137.0, 1 / 298.257222101, 0.9996
#: Codes of geographic systems, whose coordinates are degrees already.
GEOGRAPHIC = {4326, 4258, 4979}


def utm_zone(epsg: int) -> tuple[int, bool] | None:
    """(zone, north) of a UTM code, or None."""
    if 25828 <= epsg <= 25838:
        return epsg - 25800, True
    if 32601 <= epsg <= 32660:
        return epsg - 32600, True
    if 32701 <= epsg <= 32760:
        return epsg - 32700, False
    return None


def utm_to_degrees(x: np.ndarray, y: np.ndarray, zone: int, north: bool) -> tuple[np.ndarray, np.ndarray]:
    """(longitude, latitude) of UTM metres, by Krüger's series to the third order (millimetres within a zone)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    xi = (y - (0.0 if north else 10_000_000.0)) / (SCALE * radius)
    eta = (x - 500_000.0) / (SCALE * radius)
    xi0, eta0 = xi.copy(), eta.copy()
    for k, b in enumerate(beta, 1):
        xi0 -= b * np.sin(2 * k * xi) * np.cosh(2 * k * eta)
        eta0 -= b * np.cos(2 * k * xi) * np.sinh(2 * k * eta)
    chi = np.arcsin(np.sin(xi0) / np.cosh(eta0))
    lat = chi + sum(d * np.sin(2 * k * chi) for k, d in enumerate(delta, 1))
    lon = math.radians(zone * 6 - 183) + np.arctan2(np.sinh(eta0), np.cos(xi0))
    return np.degrees(lon), np.degrees(lat)


def to_degrees(points: list[tuple[float, float]], epsg: int) -> list[tuple[float, float]]:
    """(longitude, latitude) of points of a reference system. FN-28.

    Geographic codes, UTM zones and web Mercator are known; others are an error.
    """
    if not points or epsg in GEOGRAPHIC:
        return points
    xy = np.asarray(points, float)
    if zone := utm_zone(epsg):
        lon, lat = utm_to_degrees(xy[:, 0], xy[:, 1], *zone)
    elif epsg == 3857:
        lon, lat = np.degrees(xy[:, 0] / AXIS), np.degrees(2 * np.arctan(np.exp(xy[:, 1] / AXIS)) - np.pi / 2)
    else:
        raise ValueError(f"unknown reference system EPSG:{epsg}")
    return list(zip(lon.tolist(), lat.tolist()))


def _ring(points: list[tuple[float, float]]) -> bytes:
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def wkb_point(x: float, y: float) -> bytes:
    """Point in well-known binary."""
    return struct.pack("<BIdd", 1, 1, x, y)


def wkb_polygons(polygons: list[list[list[tuple[float, float]]]]) -> bytes | None:
    """Polygon, or multi-polygon of several, from rings (the first of each the outer one). FN-29, FLT-11.

    Rings of fewer than four points are left out; a polygon without its outer
    ring is, too. None where no polygon is left.
    """
    whole = [[p[0], *[r for r in p[1:] if len(r) >= 4]] for p in polygons if p and len(p[0]) >= 4]
    parts = [struct.pack("<BII", 1, 3, len(rings)) + b"".join(map(_ring, rings)) for rings in whole]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)


def bounds(points: list[tuple[float, float]]) -> tuple[float, float, float, float] | None:
    """(min x, min y, max x, max y), or None without points."""
    if not points:
        return None
    xs, ys = zip(*points)
    return min(xs), min(ys), max(xs), max(ys)

"""Geometry as column expressions: projections, ring predicates, polygon distance, elevation codes.

A ring is array<struct<lon double, lat double>>; an edge list is
array<struct<x1 double, y1 double, x2 double, y2 double>>. A polygon's edge list holds its shell's edges,
then those of its holes: with all of them, an odd number of crossings means inside the shell and in no hole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TILE = 256

# WGS 84 ellipsoid and the UTM grid.
_SEMI_MAJOR = 6378137.0
_FLATTENING = 1 / 298.257223563
_SCALE = 0.9996
_FALSE_EASTING = 500000.0


def mercator_x(lon: Column, z: int) -> Column:
    """Fractional tile column at zoom z."""
    return (lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(1 << z))


def mercator_y(lat: Column, z: int) -> Column:
    """Fractional tile row at zoom z, 0 in the north."""
    stretched = F.asinh(F.tan(F.radians(lat)))
    return (F.lit(1.0) - stretched / F.lit(math.pi)) / F.lit(2.0) * F.lit(float(1 << z))


def mercator(lon: Column, lat: Column, z: int) -> dict[str, Column]:
    """Tile and global pixel position at zoom z."""
    x, y = mercator_x(lon, z), mercator_y(lat, z)
    return {
        "tile_x": F.floor(x).cast("int"),
        "tile_y": F.floor(y).cast("int"),
        "pixel_x": x * F.lit(float(TILE)),
        "pixel_y": y * F.lit(float(TILE)),
    }


def planar(lon: Column, lat: Column) -> dict[str, Column]:
    """Web-map plane in radians, y growing southwards."""
    return {
        "plane_x": lon * F.lit(math.pi) / F.lit(180.0),
        "plane_y": -F.ln(F.tan(F.lit(math.pi / 4) + lat * F.lit(math.pi) / F.lit(360.0))),
    }


def utm(lon: Column, lat: Column, zone: int = 18) -> tuple[Column, Column]:
    """Metres east and north on the UTM grid (northern half), by the usual series expansion."""
    e2 = _FLATTENING * (2 - _FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = F.radians(lat)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    n = F.lit(_SEMI_MAJOR) / F.sqrt(1 - F.lit(e2) * sin * sin)
    t = tan * tan
    c = F.lit(ep2) * cos * cos
    a = cos * F.radians(lon - F.lit(float(zone * 6 - 183)))
    m = F.lit(_SEMI_MAJOR) * (
        F.lit(1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - F.lit(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + F.lit(15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi)
        - F.lit(35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    a2 = a * a
    a3, a4 = a2 * a, a2 * a2
    easting = F.lit(_FALSE_EASTING) + F.lit(_SCALE) * n * (
        a + (1 - t + c) * a3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a4 * a / 120
    )
    northing = F.lit(_SCALE) * (
        m + n * tan * (
            a2 / 2 + (5 - t + 9 * c + 4 * c * c) * a4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a4 * a2 / 720
        )
    )
    return easting, northing


def decode_elevation(r: Column, g: Column, b: Column) -> Column:
    """Metres from a terrain-coloured pixel."""
    return r * F.lit(256.0) + g + b / F.lit(256.0) - F.lit(32768.0)


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring, each vertex joined to the one before it."""
    before = F.concat(F.slice(ring, F.size(ring), 1), F.slice(ring, 1, F.size(ring) - 1))
    return F.zip_with(
        before,
        ring,
        lambda p, q: F.struct(
            p["lon"].alias("x1"), p["lat"].alias("y1"), q["lon"].alias("x2"), q["lat"].alias("y2")
        ),
    )


def polygon_edges(shells: Column, holes: Column) -> Column:
    """One edge list per polygon, from its shell and the list of its holes (null or missing: none)."""
    return F.zip_with(shells, F.coalesce(holes, F.array()), lambda shell, inner: F.concat(
        ring_edges(shell), F.coalesce(F.flatten(F.transform(inner, ring_edges)), F.array())))


def in_edges(x: Column, y: Column, edges: Column) -> Column:
    """Ray casting: an odd number of edges lies to the right of the point."""
    def crossed(e: Column) -> Column:
        cut = F.try_divide((e["x1"] - e["x2"]) * (y - e["y2"]), e["y1"] - e["y2"]) + e["x2"]
        return ((e["y2"] > y) != (e["y1"] > y)) & F.coalesce(x < cut, F.lit(False))

    return F.size(F.filter(edges, crossed)) % 2 == 1


def _point_to_segment(px: Column, py: Column, s: Column) -> Column:
    """Squared distance; a segment of length 0 counts as its point."""
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    along = F.try_divide((px - s["x1"]) * dx + (py - s["y1"]) * dy, dx * dx + dy * dy)
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ox, oy = px - (s["x1"] + at * dx), py - (s["y1"] + at * dy)
    return ox * ox + oy * oy


def _turn(s: Column, px: Column, py: Column) -> Column:
    return F.signum((s["x2"] - s["x1"]) * (py - s["y1"]) - (s["y2"] - s["y1"]) * (px - s["x1"]))


def _segment_gap(a: Column, b: Column) -> Column:
    """Squared distance of two segments, 0 if they cross."""
    crossing = (_turn(a, b["x1"], b["y1"]) * _turn(a, b["x2"], b["y2"]) < 0) & (
        _turn(b, a["x1"], a["y1"]) * _turn(b, a["x2"], a["y2"]) < 0
    )
    ends = F.least(
        _point_to_segment(a["x1"], a["y1"], b),
        _point_to_segment(a["x2"], a["y2"], b),
        _point_to_segment(b["x1"], b["y1"], a),
        _point_to_segment(b["x2"], b["y2"], a),
    )
    return F.when(crossing, F.lit(0.0)).otherwise(ends)


def _holds_any(polygons: Column, others: Column) -> Column:
    """Whether a shell of ``others`` begins inside one of ``polygons``."""
    return F.exists(others, lambda other: F.exists(
        polygons, lambda edges: in_edges(F.get(other, F.lit(0))["x1"], F.get(other, F.lit(0))["y1"], edges)))


def polygons_distance(a: Column, b: Column) -> Column:
    """Distance of two lists of polygons given by their edges.

    It is 0 where they touch or a shell of one lies in the other outside of its holes; inside of a hole it is the
    distance to the hole's ring.
    """
    gap = F.array_min(F.transform(F.flatten(a), lambda s: F.array_min(F.transform(F.flatten(b), lambda t: _segment_gap(s, t)))))
    return F.when(_holds_any(a, b) | _holds_any(b, a), F.lit(0.0)).otherwise(F.sqrt(gap))

"""Planar geometry over arrays of edges, the inverse transverse Mercator projection, and datum shifts."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, functions as F

_ON_EDGE = 1 << 40  # larger than any crossing count


class Ellipsoid(NamedTuple):
    semi_major: float
    flattening: float


class Shift(NamedTuple):
    """Position-vector parameters: metres, arc seconds, and parts per million."""

    dx: float
    dy: float
    dz: float
    rx: float = 0.0
    ry: float = 0.0
    rz: float = 0.0
    ppm: float = 0.0


# Ellipsoids, the published shift from Indian 1975 to WGS 84, and UTM constants.
WGS_84 = Ellipsoid(6378137.0, 1 / 298.257223563)
EVEREST_1937 = Ellipsoid(6377276.345, 1 / 300.8017)
INDIAN_1975_SHIFT = Shift(210.0, 814.0, 289.0)
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0


def upward(edges: Column) -> Column:
    """Edges with the lower end first and their x range added: the form ``strictly_inside`` tests."""

    def turned(e: Column) -> Column:
        up = e.y1 <= e.y2
        return F.struct(
            F.when(up, e.x1).otherwise(e.x2).alias("x1"), F.least(e.y1, e.y2).alias("y1"),
            F.when(up, e.x2).otherwise(e.x1).alias("x2"), F.greatest(e.y1, e.y2).alias("y2"),
            F.least(e.x1, e.x2).alias("xlo"), F.greatest(e.x1, e.x2).alias("xhi"),
        )

    return F.transform(edges, turned)


def strictly_inside(x: Column, y: Column, edges: Column) -> Column:
    """True when (x, y) is inside the even-odd area of the upward ``edges`` and on none of them.

    One pass: a ray to +x counts crossings, and a zero cross product within
    the edge's box marks a boundary point. Most edges are settled by comparing
    ranges; no division, so nothing can raise.
    """

    def score(total: Column, e: Column) -> Column:
        side = (e.x2 - e.x1) * (y - e.y1) - (x - e.x1) * (e.y2 - e.y1)
        # An edge owns its lower end but not its upper one, so a shared corner counts once.
        return (
            F.when((y < e.y1) | (y > e.y2) | (x > e.xhi), total)
            .when(x < e.xlo, F.when(y < e.y2, total + 1).otherwise(total))
            .when(side == 0, total + _ON_EDGE)
            .when((side > 0) & (y < e.y2), total + 1)
            .otherwise(total)
        )

    total = F.aggregate(edges, F.lit(0).cast("bigint"), score)
    return (total < _ON_EDGE) & (total % 2 == 1)


def rings_to_edges(rings: Column) -> Column:
    """Rings (arrays of [x, y]) to edges; an open ring is closed, zero-length edges go."""

    def ring_edges(ring: Column) -> Column:
        ends = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            ends,
            lambda a, b: F.struct(
                F.get(a, F.lit(0)).alias("x1"), F.get(a, F.lit(1)).alias("y1"),
                F.get(b, F.lit(0)).alias("x2"), F.get(b, F.lit(1)).alias("y2"),
            ),
        )

    edges = F.flatten(F.transform(rings, ring_edges))
    return F.filter(edges, lambda e: (e.x1 != e.x2) | (e.y1 != e.y2))


def _each(points: Column, *steps) -> Column:
    """The points through one step after the other. Each is a transform of its own: the columns of a step, which the next
    one uses many times, are computed once and named, instead of being written out wherever they occur."""
    for step in steps:
        points = F.transform(points, lambda p: F.struct(*[c.alias(n) for n, c in step(p).items()]))
    return points


def edge_ends(edges: Column) -> Column:
    """Both ends of each edge, one behind the other."""
    both = F.transform(edges, lambda e: F.array(F.struct(e.x1.alias("x"), e.y1.alias("y")), F.struct(e.x2.alias("x"), e.y2.alias("y"))))
    return F.flatten(both)


def ends_to_edges(points: Column) -> Column:
    """The inverse of ``edge_ends``."""
    pairs = F.filter(points, lambda p, i: i % 2 == 0), F.filter(points, lambda p, i: i % 2 == 1)
    return F.zip_with(*pairs, lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")))


def utm_to_lonlat(points: Column, zone: Column, south: Column, ellipsoid: Ellipsoid = WGS_84) -> Column:
    """Points (x, y) in UTM to degrees of longitude and latitude on the same ellipsoid (Krüger series, third order in n)."""
    n = ellipsoid.flattening / (2 - ellipsoid.flattening)
    radius = ellipsoid.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    base = F.when(south, F.lit(FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))

    def scaled(p: Column) -> dict[str, Column]:
        return {"xi": (p.y - base) / (SCALE * radius), "eta": (p.x - FALSE_EASTING) / (SCALE * radius)}

    def unwound(p: Column) -> dict[str, Column]:
        xi, eta = p.xi, p.eta
        for j, b in enumerate(beta, 1):
            xi = xi - F.sin(2 * j * p.xi) * F.cosh(2 * j * p.eta) * b
            eta = eta - F.cos(2 * j * p.xi) * F.sinh(2 * j * p.eta) * b
        return {"xi": xi, "eta": eta}

    def conformal(p: Column) -> dict[str, Column]:
        return {"x": zone * 6 - 183 + F.degrees(F.atan2(F.sinh(p.eta), F.cos(p.xi))), "chi": F.asin(F.sin(p.xi) / F.cosh(p.eta))}

    def geodetic(p: Column) -> dict[str, Column]:
        latitude = p.chi
        for j, d in enumerate(delta, 1):
            latitude = latitude + F.sin(2 * j * p.chi) * d
        return {"x": p.x, "y": F.degrees(latitude)}

    return _each(points, scaled, unwound, conformal, geodetic)


def shift_datum(points: Column, source: Ellipsoid, target: Ellipsoid, shift: Shift) -> Column:
    """Points in degrees on one datum to degrees on another, at height zero: by way of geocentric coordinates and seven parameters.

    The way back to latitude is Bowring's closed form, exact to well under a millimetre near the surface.
    """
    e2 = source.flattening * (2 - source.flattening)
    second = math.pi / 180 / 3600
    rx, ry, rz, m = shift.rx * second, shift.ry * second, shift.rz * second, 1 + shift.ppm * 1e-6
    a, f = target
    b, t2 = a * (1 - f), f * (2 - f)

    def angles(p: Column) -> dict[str, Column]:
        lon, lat = F.radians(p.x), F.radians(p.y)
        return {"sl": F.sin(lon), "cl": F.cos(lon), "sb": F.sin(lat), "cb": F.cos(lat)}

    def normal(p: Column) -> dict[str, Column]:
        return {"sl": p.sl, "cl": p.cl, "sb": p.sb, "cb": p.cb, "n": F.lit(source.semi_major) / F.sqrt(1 - e2 * p.sb * p.sb)}

    def geocentric(p: Column) -> dict[str, Column]:
        return {"x": p.n * p.cb * p.cl, "y": p.n * p.cb * p.sl, "z": p.n * (1 - e2) * p.sb}

    def moved(p: Column) -> dict[str, Column]:
        return {
            "x": shift.dx + m * (p.x - rz * p.y + ry * p.z), "y": shift.dy + m * (rz * p.x + p.y - rx * p.z),
            "z": shift.dz + m * (rx * p.y - ry * p.x + p.z),
        }

    def reduced(p: Column) -> dict[str, Column]:
        flat = F.sqrt(p.x * p.x + p.y * p.y)
        return {"x": F.degrees(F.atan2(p.y, p.x)), "z": p.z, "flat": flat, "theta": F.atan2(p.z * a, flat * b)}

    def geodetic(p: Column) -> dict[str, Column]:
        up = p.z + (t2 / (1 - t2)) * b * F.pow(F.sin(p.theta), 3)
        return {"x": p.x, "y": F.degrees(F.atan2(up, p.flat - t2 * a * F.pow(F.cos(p.theta), 3)))}

    return _each(points, angles, normal, geocentric, moved, reduced, geodetic)

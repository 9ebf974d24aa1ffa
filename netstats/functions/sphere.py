"""Expressions on the unit sphere: edges as arcs of great circles, and the even-odd test along a meridian.

An arc joins its ends the short way round. Its ends must be less than half a turn of longitude apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What rounding leaves of a product of unit vectors that is zero.
ROUNDING = 1e-15


def wrapped(degrees: Column) -> Column:
    """The same angle from -180 up to, not including, 180."""
    return degrees - 360 * F.floor((degrees + 180) / 360)


def unit_vector(lon: Column, lat: Column) -> list[Column]:
    x, y = F.radians(lon), F.radians(lat)
    return [F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y)]


def dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _fields(e: Column, names: str) -> list[Column]:
    return [e[n] for n in names.split()]


def arc(e: Column) -> Column:
    """An edge with its latitudes, the vectors of its ends, their product and the normal of its great circle."""
    a, b = unit_vector(e["x1"], e["y1"]), unit_vector(e["x2"], e["y2"])
    normal = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    named = zip("ax ay az bx by bz nx ny nz".split(), [*a, *b, *normal], strict=True)
    return F.struct(
        *[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")], *[c.alias(n) for n, c in named], dot(a, b).alias("ab")
    )


def reach(e: Column) -> Column:
    """Degrees by which an arc may at most leave the latitudes of its ends: half its length."""
    return F.degrees(F.acos(F.greatest(F.least(e["ab"], F.lit(1.0)), F.lit(-1.0)))) / 2


def turns(ring: Column) -> Column:
    """Degrees of longitude that the edges of a ring go round the axis: 0, 360 or -360, but for rounding."""
    return F.aggregate(ring, F.lit(0.0), lambda total, e: total + wrapped(e["x2"] - e["x1"]))


def above_equator(ring: Column) -> Column:
    """Signed area between the arcs of a ring and the equator; positive north of it and eastward."""

    def area(e: Column) -> Column:
        t1, t2 = F.tan(F.radians(e["y1"]) / 2), F.tan(F.radians(e["y2"]) / 2)
        return 2 * F.atan(F.tan(F.radians(wrapped(e["x2"] - e["x1"])) / 2) * (t1 + t2) / (1 + t1 * t2))

    return F.aggregate(ring, F.lit(0.0), lambda total, e: total + area(e))


def arc_crosses(lon: Column, vector: list[Column], e: Column) -> Column:
    """Whether an arc passes between a point and the north pole, on the point's meridian."""
    side = dot(_fields(e, "nx ny nz"), vector)
    d1, d2 = wrapped(e["x1"] - lon), wrapped(e["x2"] - lon)
    meets = ((d1 > 0) != (d2 > 0)) & (F.abs(d1 - d2) < 180)
    return meets & F.when(d2 > d1, side < 0).otherwise(side > 0)


def arc_touches(vector: list[Column], e: Column) -> Column:
    """Whether a point lies on an arc, as far as doubles show it."""
    a, b = dot(_fields(e, "ax ay az"), vector), dot(_fields(e, "bx by bz"), vector)
    side = dot(_fields(e, "nx ny nz"), vector)
    return (F.abs(side) <= ROUNDING) & (F.least(a, b) >= e["ab"] - ROUNDING)

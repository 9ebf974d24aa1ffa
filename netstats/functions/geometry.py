"""Polygon expressions: text parsing, edges and the even-odd point test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text. Holes are ordinary rings here."""
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)
    return F.transform(texts, lambda ring: F.transform(F.split(F.trim(ring), r"\s*,\s*"), _point))


def _point(pair: Column) -> Column:
    xy = F.split(pair, r"\s+")
    return F.struct(
        F.get(xy, F.lit(0)).cast("double").alias("x"), F.get(xy, F.lit(1)).cast("double").alias("y")
    )


def rings_from_geojson(kind: Column, coordinates: Column) -> Column:
    """Rings from a GeoJSON geometry type and the text of its coordinates."""
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    rings = F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi)
    return F.transform(
        rings,
        lambda ring: F.transform(
            ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
        ),
    )


def edges(rings: Column) -> Column:
    """All edges of all rings; a ring that is not closed gets its last edge."""

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        pairs = F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )
        return F.filter(pairs, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))

    return F.flatten(F.transform(rings, ring_edges))


def _side(x: Column, y: Column, e: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def crosses(x: Column, y: Column, e: Column) -> Column:
    """Whether an edge passes to the right of (x, y)."""
    side = _side(x, y, e)
    straddles = (e["y1"] > y) != (e["y2"] > y)
    return straddles & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)


def touches(x: Column, y: Column, e: Column) -> Column:
    """Whether (x, y) lies on an edge."""
    in_box = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(
        F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    )
    return in_box & (_side(x, y, e) == 0)


def within(x: Column, y: Column, some_edges: Column) -> Column:
    """Whether (x, y) lies strictly inside, by the parity of edges to its right.

    `some_edges` needs only the edges whose y-range reaches y. A point on an edge
    is not inside, and holes work because they add crossings.
    """
    crossed = F.size(F.filter(some_edges, lambda e: crosses(x, y, e)))
    return (crossed % 2 == 1) & ~F.exists(some_edges, lambda e: touches(x, y, e))

"""Point-in-polygon join on the sphere: great-circle edges, the antimeridian and the poles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.functions.geometry import edges
from netstats.functions.sphere import above_equator, arc, arc_crosses, arc_touches, reach, turns, unit_vector, wrapped
from netstats.operators.spatial import EDGES_PER_STRIP, GRIDS, MOST_STRIPS, by_cell, cell, grid_of, inside

# Degrees by which boxes and strips are widened against rounding.
HAIR = 1e-9


def _shapes(boundaries: DataFrame) -> DataFrame:
    """Arcs, box, grid and number of strips of each polygon. Longitudes in `west` to `east` count from `x0`."""
    rings = F.transform("rings", lambda ring: edges(F.array(ring)))
    split = boundaries.select("geo_id", F.filter(rings, lambda ring: F.size(ring) > 0).alias("loops"))
    around = F.filter("loops", lambda ring: F.abs(turns(ring)) > 180)
    # A ring around the axis divides the poles; its inside is the smaller part of the sphere.
    northern = F.filter(around, lambda ring: F.signum(turns(ring)) * above_equator(ring) > 0)
    poles = split.where(F.size("loops") > 0).select(
        "geo_id",
        F.transform(F.flatten("loops"), arc).alias("arcs"),
        F.col("loops")[0][0]["x1"].alias("x0"),
        (F.size(northern) % 2 == 1).alias("north"),
        ((F.size(around) - F.size(northern)) % 2 == 1).alias("south"),
        F.size(around).alias("around"),
    )
    first = F.transform("arcs", lambda e: wrapped(e["x1"] - F.col("x0")))
    seam = F.exists("arcs", lambda e: F.abs(wrapped(e["x1"] - F.col("x0")) - wrapped(e["x2"] - F.col("x0"))) >= 180)
    full = (F.col("around") > 0) | seam
    low = F.array_min(F.transform("arcs", lambda e: F.least(e["y1"], e["y2"]) - reach(e)))
    high = F.array_max(F.transform("arcs", lambda e: F.greatest(e["y1"], e["y2"]) + reach(e)))
    boxed = poles.select(
        "geo_id", "arcs", "x0", "north",
        F.when(full, F.lit(-180.0)).otherwise(F.array_min(first) - HAIR).alias("west"),
        F.when(full, F.lit(180.0)).otherwise(F.array_max(first) + HAIR).alias("east"),
        F.when(F.col("south"), F.lit(-90.0)).otherwise(F.greatest(low - HAIR, F.lit(-90.0))).alias("y_min"),
        F.when(F.col("north"), F.lit(90.0)).otherwise(F.least(high + HAIR, F.lit(90.0))).alias("y_max"),
    )
    width = F.greatest(F.col("east") - F.col("west"), F.col("y_max") - F.col("y_min"))
    strips = F.floor(F.size("arcs") / EDGES_PER_STRIP)
    return boxed.select(
        "*",
        grid_of(width).alias("grid"),
        F.least(F.greatest(strips, F.lit(1)), F.lit(MOST_STRIPS)).cast("int").alias("strips"),
    )


def _strip(from_x0: Column) -> Column:
    """Strip of a longitude counted from x0."""
    part = (from_x0 - F.col("west")) / (F.col("east") - F.col("west")) * F.col("strips")
    return F.least(F.greatest(F.floor(part), F.lit(0)), F.col("strips") - 1).cast("int")


def _arc_strips(e: str) -> Column:
    """The strips that an arc reaches; one that passes the far side of x0 has both ends of them."""
    a, b = wrapped(F.col(f"{e}.x1") - F.col("x0")), wrapped(F.col(f"{e}.x2") - F.col("x0"))
    low, high = F.least(a, b), F.greatest(a, b)
    direct = F.sequence(_strip(low - HAIR), _strip(high + HAIR))
    ends = F.concat(
        F.sequence(F.lit(0), _strip(low + HAIR)), F.sequence(_strip(high - HAIR), F.col("strips") - 1)
    )
    return F.when(high - low >= 180, F.array_distinct(ends)).otherwise(direct)


def locate_on_sphere(points: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(lon, lat, geo_id) for every distinct point and polygon around it, where edges are arcs of great circles.

    As `locate_points`, with strips of longitude. Polygons may lie across the antimeridian; of a ring around a pole
    the smaller side is inside, of any other ring the side without the poles. Points with a latitude beyond 90
    degrees are nowhere; longitudes may be any number of turns off.
    """
    shapes = _shapes(boundaries)
    grid = F.col("grid")
    # Boxes in longitudes from -180 to 180: one that lies across the antimeridian comes as two that are apart.
    whole = F.col("east") - F.col("west") > 359
    start = F.when(whole, F.lit(-180.0)).otherwise(wrapped(F.col("x0")) + F.col("west"))
    stop = F.when(whole, F.lit(180.0)).otherwise(wrapped(F.col("x0")) + F.col("east"))
    shifts = F.when(whole, F.array(F.lit(0))).otherwise(F.array(*[F.lit(k) for k in (-360, 0, 360)]))
    cells = (
        shapes.drop("arcs")
        .withColumn("shift", F.explode(shifts))
        .withColumn("x_min", F.greatest(start + F.col("shift"), F.lit(-180.0)))
        .withColumn("x_max", F.least(stop + F.col("shift"), F.lit(180.0)))
        .where("x_min <= x_max")
        .withColumn("col", F.explode(F.sequence(cell(F.col("x_min"), grid), cell(F.col("x_max"), grid))))
        .withColumn("row", F.explode(F.sequence(cell(F.col("y_min"), grid), cell(F.col("y_max"), grid))))
    )
    strips = (
        shapes.withColumn("e", F.explode("arcs"))
        .select("geo_id", F.explode(_arc_strips("e")).alias("strip"), "e")
        .groupBy("geo_id", "strip")
        .agg(F.collect_list("e").alias("edges"))
    )
    distinct = (
        points.select("lon", "lat")
        .where(F.col("lon").isNotNull() & F.col("lat").between(-90, 90))
        .distinct()
        .withColumn("x", wrapped(F.col("lon")))
        .withColumn("grid", F.explode(F.array(*[F.lit(g) for g in GRIDS])))
        .withColumn("col", cell(F.col("x"), grid))
        .withColumn("row", cell(F.col("lat"), grid))
    )
    near = (
        by_cell(distinct).join(by_cell(cells), ["grid", "col", "row"])
        .where(F.col("x").between(F.col("x_min"), F.col("x_max")))
        .where(F.col("lat").between(F.col("y_min"), F.col("y_max")))
        .select(
            "grid", "col", "row", "lon", "lat", "geo_id", "north",
            _strip(wrapped(F.col("lon") - F.col("x0"))).alias("strip"),
            *[c.alias(n) for n, c in zip("uvw", unit_vector(F.col("lon"), F.col("lat")), strict=True)],
        )
    )
    vector, e = [F.col(c) for c in "uvw"], F.col("e")
    return inside(near, strips, arc_crosses(F.col("lon"), vector, e), arc_touches(vector, e), odd=~F.col("north"))

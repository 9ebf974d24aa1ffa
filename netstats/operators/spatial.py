"""Point-in-polygon join over grids, and dissolving of polygons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.functions.geometry import crosses, edges, touches
from netstats.limits import DEFAULT
from netstats.operators.skew import join_null_safe

#: What finds the polygons around points: (points, boundaries) to (lon, lat, geo_id).
Locate = Callable[[DataFrame, DataFrame], DataFrame]

# Grids whose cells are 2^-8 to 2^8 degrees wide. A polygon lies in the finest one whose cells
# are no smaller than a quarter of it, so it touches at most 25 cells; one of less than 2^-8 or of
# more than 256 degrees lies in the first or last.
GRIDS = list(range(-8, 9, 2))
# Edges that a latitude strip of a polygon should hold, and strips it may have.
EDGES_PER_STRIP, MOST_STRIPS = 16, 256


def cell(coordinate: Column, grid: Column) -> Column:
    """Number of the cell that holds a coordinate."""
    return F.floor(coordinate / F.pow(F.lit(2.0), grid)).cast("bigint")


def grid_of(width: Column) -> Column:
    """Grid for a polygon of some width: cells as wide as a box would have few keys, and tasks, for all points of large polygons."""
    quarter = F.ceil(F.log2(width / 4) / 2) * 2
    return F.least(F.greatest(quarter, F.lit(GRIDS[0])), F.lit(GRIDS[-1])).cast("int")


def by_cell(rows: DataFrame) -> DataFrame:
    """Rows dealt by their cell. Few bytes may mean many pairs, so Spark is not to merge these tasks by their size."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "grid", "col", "row")


def inside(near: DataFrame, strips: DataFrame, crosses: Column, touches: Column, odd: Column | None = None) -> DataFrame:
    """(lon, lat, geo_id) of those pairs whose point lies inside: an odd number of edges is crossed, or not, and none is touched.

    `near` holds a point's cell and its strip of a polygon, `strips` the edges there; `crosses` and `touches` are about
    an edge `e`. Edges are rows here, since Spark compiles expressions over rows, but interprets those over members of
    arrays. The groups lie within a task as the joins leave them. A pair that comes repeatedly, as its polygon does,
    is found as often.
    """
    keys = ["grid", "col", "row", "lon", "lat", "geo_id", "strip"]
    odd = F.lit(True) if odd is None else odd
    edge_rows = (
        near.join(strips, ["geo_id", "strip"])
        .withColumn("held", F.size("edges"))
        .withColumn("e", F.explode("edges"))
        .select(*keys, "held", odd.alias("odd"), crosses.alias("crossed"), F.coalesce(touches, F.lit(True)).alias("touched"))
    )
    pairs = edge_rows.groupBy(*keys, "held", "odd").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("crossed").alias("crossed"), F.bool_or("touched").alias("touched")
    )
    return (
        pairs.withColumn("copies", F.expr("rows DIV held"))
        .where(~F.col("touched") & (F.expr("crossed DIV copies % 2 = 1") == F.col("odd")))
        .select("lon", "lat", "geo_id", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
        .drop("copy")
    )


def _shapes(boundaries: DataFrame) -> DataFrame:
    """Edges, bounding box, grid and number of strips of each polygon."""
    vertices = F.flatten("rings")
    xs = F.transform(vertices, lambda v: v["x"])
    ys = F.transform(vertices, lambda v: v["y"])
    boxed = boundaries.select(
        "geo_id",
        edges(F.col("rings")).alias("edges"),
        F.array_min(xs).alias("x_min"),
        F.array_max(xs).alias("x_max"),
        F.array_min(ys).alias("y_min"),
        F.array_max(ys).alias("y_max"),
    )
    width = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
    strips = F.floor(F.size("edges") / EDGES_PER_STRIP)
    return boxed.where(width > 0).select(
        "*",
        grid_of(width).alias("grid"),
        F.least(F.greatest(strips, F.lit(1)), F.lit(MOST_STRIPS)).cast("int").alias("strips"),
    )


def _strip(y: Column) -> Column:
    """Strip of a latitude; grows with y, so an edge's strips cover all its latitudes."""
    height = F.col("y_max") - F.col("y_min")
    part = F.try_divide(y - F.col("y_min"), height) * F.col("strips")
    return F.coalesce(F.floor(part), F.lit(0)).cast("int")


def locate_points(points: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(lon, lat, geo_id) for every distinct point and polygon around it.

    Two equi-joins: points meet polygons whose bounding box covers their cell, and
    each remaining pair meets those edges of the polygon that lie in the point's
    latitude strip. A polygon of nearly any size gives at most 25 cells, and its edges
    are stored about once; the exact test reads only a strip of them.
    """
    # Few bytes may be many polygons, and these are unfolded.
    shapes = _shapes(boundaries.repartition("geo_id"))
    box = ["x_min", "x_max", "y_min", "y_max", "strips"]
    grid = F.col("grid")
    cells = (
        shapes.select("geo_id", *box, "grid")
        .withColumn("col", F.explode(F.sequence(cell(F.col("x_min"), grid), cell(F.col("x_max"), grid))))
        .withColumn("row", F.explode(F.sequence(cell(F.col("y_min"), grid), cell(F.col("y_max"), grid))))
    )
    strips = (
        shapes.select("geo_id", "y_min", "y_max", "strips", F.explode("edges").alias("e"))
        .withColumn(
            "strip",
            F.explode(
                F.sequence(_strip(F.least("e.y1", "e.y2")), _strip(F.greatest("e.y1", "e.y2")))
            ),
        )
        .groupBy("geo_id", "strip")
        .agg(F.collect_list("e").alias("edges"))
    )
    distinct = (
        points.select("lon", "lat")
        .where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .distinct()
        .withColumn("grid", F.explode(F.array(*[F.lit(g) for g in GRIDS])))
        .withColumn("col", cell(F.col("lon"), grid))
        .withColumn("row", cell(F.col("lat"), grid))
    )
    near = (
        by_cell(distinct).join(by_cell(cells), ["grid", "col", "row"])
        .where(F.col("lon").between(F.col("x_min"), F.col("x_max")))
        .where(F.col("lat").between(F.col("y_min"), F.col("y_max")))
        .select("grid", "col", "row", "lon", "lat", "geo_id", _strip(F.col("lat")).alias("strip"))
    )
    lon, lat, e = F.col("lon"), F.col("lat"), F.col("e")
    return inside(near, strips, crosses(lon, lat, e), touches(lon, lat, e))


def located(cleaned: DataFrame, boundaries: DataFrame, locate: Locate = locate_points) -> DataFrame:
    """(lon, lat, GEOID, names): the polygons around each distinct coordinate of the tests.

    Coordinates come from address databases and repeat a great deal, so the exact
    test runs once per distinct point, and one lookup serves all levels of a layer.
    `locate` may be `locate_on_sphere`.
    """
    names = [c for c in boundaries.columns if c not in ("geo_id", "rings")]
    found = locate(cleaned, boundaries)
    return found.join(boundaries.select("geo_id", *names).hint("merge"), "geo_id").withColumnRenamed(
        "geo_id", "GEOID"
    )


def attach_boundary(cleaned: DataFrame, lookup: DataFrame) -> DataFrame:
    """Cleaned tests with what a lookup made by `located` says of their coordinates."""
    return join_null_safe(cleaned, lookup, ["lon", "lat"])


def few_tasks(rows: DataFrame, n: int) -> DataFrame:
    """`n` rows that are kept, read by as many tasks as they ask for: each task of the next shuffle writes to all its partitions."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // DEFAULT.rows_per_task)))


def alike(lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lon, lat, area) and (area, names): areas around the same coordinates, as one that stands for all of them.

    A lookup has a row for each coordinate and polygon around it, and tests that meet it are multiplied by the polygons
    that overlap there. What is found out about the tests of an area holds for every polygon around the same
    coordinates, however the polygons are shaped, so tests need to meet only one of these. Polygons with the same number
    and digests of coordinates are compared with the smallest of them, coordinate by coordinate; one that differs
    stands for itself. `area` is a struct of the names that the polygon has which stands for the others.
    """
    names = [c for c in lookup.columns if c not in ("lon", "lat")]
    points = (
        lookup.groupBy(F.struct(*names).alias("member"), "lon", "lat")
        .agg(F.count(F.lit(1)).alias("copies"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # Several steps read them; without this each would look for them at the same time.
    cached, points = points, few_tasks(points, points.count())
    place = ["lon", "lat", "copies"]
    digests = points.groupBy("member").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(*place)).alias("digest1"),
        F.bit_xor(F.xxhash64(F.lit(1), *place)).alias("digest2"),
    )
    first = digests.groupBy("n", "digest1", "digest2").agg(F.min("member").alias("first"))
    claims = digests.join(first, ["n", "digest1", "digest2"]).select("member", "n", "first")
    shared = (
        points.join(claims, "member")
        .join(points.withColumnRenamed("member", "first"), ["first", *place])
        .groupBy("member", "first", "n")
        .agg(F.count(F.lit(1)).alias("met"))
    )
    area = F.when(F.col("met") == F.col("n"), F.col("first")).otherwise(F.col("member"))
    # Without a coordinate in common with the first there is no row, and the polygon stands for itself.
    members = digests.select("member").join(shared, "member", "left").select(
        F.coalesce(area, F.col("member")).alias("area"), F.col("member")
    )
    members = members.persist(StorageLevel.MEMORY_AND_DISK)
    members = few_tasks(members, members.count())
    standing = members.where("area = member").select("area")
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")
    around = (
        points.withColumnRenamed("member", "area")
        .join(standing, "area", "left_semi")
        .select("lon", "lat", "area", repeated)
        .drop("copy")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    around = few_tasks(around, around.count())
    cached.unpersist()
    return around, members.select("area", "member.*")


def dissolve(pieces: DataFrame, by: str, copy: tuple[str, ...] = ()) -> DataFrame:
    """Outline of the union of polygons that share `by`: one row per remaining edge.

    An edge that two neighbours share appears twice and disappears. Grouping by
    edge as well as by `by` spreads a region with very many pieces.
    """
    parts = pieces.select(by, *copy, F.explode(edges(F.col("rings"))).alias("e"))
    a = F.struct(F.col("e.x1").alias("x"), F.col("e.y1").alias("y"))
    b = F.struct(F.col("e.x2").alias("x"), F.col("e.y2").alias("y"))
    once = (
        parts.withColumn("a", F.least(a, b))
        .withColumn("b", F.greatest(a, b))
        .groupBy(by, "a", "b")
        .agg(F.count(F.lit(1)).alias("uses"), *[F.min(c).alias(c) for c in copy])
        .where(F.col("uses") == 1)
    )
    return once.select(
        by,
        *copy,
        F.col("a.x").alias("x1"),
        F.col("a.y").alias("y1"),
        F.col("b.x").alias("x2"),
        F.col("b.y").alias("y2"),
    )

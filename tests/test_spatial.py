from __future__ import annotations

import math
import random

import pytest
from helpers import as_set, both_directions, frame_of, speed_test
from pyspark.sql import functions as F

from netstats.levels import COUNTY_ATTRIBUTES
from netstats.operators.outlines import _checkpointed, _directed_outline, dissolve_layer, dissolve_rings
from netstats.operators.sampling import draw
from netstats.operators.skew import join_null_safe
from netstats.operators.spatial import alike, dissolve, locate_points
from netstats.operators.sphere import locate_on_sphere
from netstats.plans.histograms import level_histogram, prepare
from netstats.schema import RINGS
from netstats.sources.geography import boundaries_from_wkt, read_geojson, tract_ids

SQUARE_WITH_HOLE = (
    "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4)), "
    "((20 0, 24 0, 22 4, 20 0)))"
)


def located(spark, wkt, points):
    layer = boundaries_from_wkt(
        spark.createDataFrame([(7, wkt)], "geo_id INT, shape STRING"), "shape"
    )
    frame = spark.createDataFrame(points, "lon DOUBLE, lat DOUBLE")
    return {(r.lon, r.lat) for r in locate_points(frame, layer).collect()}


def test_rings_and_edges(spark):
    inside = {(1.0, 1.0), (3.9, 5.0), (22.0, 1.0)}
    outside = {(5.0, 5.0), (15.0, 5.0), (24.0, 3.0), (-1.0, 1.0)}
    on_edge = {(0.0, 5.0), (5.0, 0.0), (10.0, 10.0), (4.0, 5.0), (0.0, 0.0), (22.0, 4.0)}
    assert located(spark, SQUARE_WITH_HOLE, list(inside | outside | on_edge)) == inside


def crossings(x, y, rings):
    count = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                count += 1
    return count


def test_many_polygons_of_all_sizes(spark):
    """Against a direct check of every point and polygon."""
    rng = random.Random(5)
    shapes = []
    for i in range(60):
        size = 10 ** rng.uniform(-3, 2)
        x, y = rng.uniform(-60, 60), rng.uniform(-60, 60)
        n = rng.choice([3, 4, 9, 120])
        ring = [(x + size * rng.uniform(-1, 1), y + size * rng.uniform(-1, 1)) for _ in range(n)]
        shapes.append((f"p{i}", [ring]))
    points = [(rng.uniform(-150, 150), rng.uniform(-80, 80)) for _ in range(150)]
    points += [(r[0][0][0] + 1e-4, r[0][0][1] + 1e-4) for _, r in shapes]
    layer = spark.createDataFrame(
        [(g, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for g, rings in shapes],
        f"geo_id STRING, rings {RINGS}",
    )
    frame = spark.createDataFrame(points * 2, "lon DOUBLE, lat DOUBLE")
    direct = {(x, y, g) for x, y in points for g, r in shapes if crossings(x, y, r) % 2}
    assert set(map(tuple, locate_points(frame, layer).collect())) == direct


def test_null_keys_meet(spark):
    big = spark.range(200).select((F.col("id") % 5 % 3).alias("k"), F.col("id").alias("fp"))
    big = big.withColumn("k", F.when(F.col("k") > 0, F.col("k"))).withColumn("fp", F.when(F.col("fp") % 2 > 0, F.col("fp")))
    small = spark.createDataFrame([(None, "none"), (1, "one"), (1, "uno")], "k BIGINT, v STRING")
    assert join_null_safe(big, small, ["k"]).count() == 40 * 2 + 40 * 2 + 80
    assert join_null_safe(big, small, ["k"], "left").count() == 40 * 2 + 40 * 2 + 80 + 40


def test_county_level_with_attributes_and_two_states(spark):
    county = {
        "geo_id": "06001", "county_name": "A", "state_fips_code": "06", "county_fips_code": "001",
        "county_gnis_code": "1", "lsad_name": "A County", "lsad_code": "06", "fips_class_code": "H1",
    }
    layer = spark.createDataFrame([county]).withColumn(
        "wkt", F.lit("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")
    )
    layer = boundaries_from_wkt(layer, "wkt")
    rows = [
        speed_test(1, 1.0, ip="10.0.0.1"),
        speed_test(2, 2.0, ip="10.0.0.2", Subdivision1ISOCode="NV"),
        speed_test(3, 3.0, ip="10.0.0.3", Longitude=9.0),
        speed_test(4, 3.0, ip="10.0.0.4", Longitude=None),
    ]
    tests = frame_of(spark, both_directions(rows))
    table = level_histogram("counties", prepare(tests), {"counties": layer})
    found = {(r.state, r.GEOID, r.county_name, r.dl_samples_day) for r in table.collect()}
    assert found == {("US-CA", "06001", "A", 1), ("US-NV", "06001", "A", 1)}


def test_state_level_drops_rows_without_region_code(spark):
    layer = spark.createDataFrame(
        [("06", "CA", "", "POLYGON ((0 0, 1 0, 1 1, 0 1))")],
        "geo_id STRING, state STRING, state_name STRING, wkt STRING",
    )
    rows = [
        speed_test(1, 1.0, ip="10.0.0.1"),
        speed_test(2, 1.0, ip="10.0.0.2", Subdivision1ISOCode=None, Region=None),
        speed_test(3, 1.0, ip="10.0.0.3", Subdivision1ISOCode="", Region=""),
    ]
    prepared = prepare(frame_of(spark, both_directions(rows)))
    table = level_histogram("states", prepared, {"states": boundaries_from_wkt(layer, "wkt")})
    assert {r.ISO3166_2region1 for r in table.collect()} == {"US-CA", "US-"}


def test_dissolve_removes_shared_edges(spark):
    wkt = "POLYGON ((%d 0, %d 0, %d 1, %d 1, %d 0))"
    rows = [("t", wkt % (i, i + 1, i + 1, i, i)) for i in range(3)]
    layer = spark.createDataFrame(rows, "tract STRING, wkt STRING").withColumn("geo_id", F.lit("x"))
    outline = dissolve(boundaries_from_wkt(layer, "wkt"), "tract")
    assert outline.count() == 8
    assert outline.where("x1 = x2 AND x1 IN (1, 2)").count() == 0


def boxes(spark, squares, turned=False):
    """Unit squares at (x, y), closed; every other one clockwise if `turned`."""
    rows = []
    for i, (tract, x, y) in enumerate(squares):
        corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
        ring = corners[::-1] if turned and i % 2 else corners
        rows.append((tract, [[(float(a), float(b)) for a, b in ring]]))
    return spark.createDataFrame(rows, f"tract STRING, rings {RINGS}")


def plain_rings(found):
    return sorted((r.tract, r.hole, r.area, [(p.x, p.y) for p in r.ring]) for r in found.collect())


@pytest.mark.parametrize("turned", [False, True])
def test_dissolved_rings(spark, turned):
    around = [("a", x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    apart = [("b", 0, 0), ("b", 5, 5), (None, 9, 9)]
    found = plain_rings(dissolve_rings(boxes(spark, around + apart, turned), "tract"))
    assert [(t, hole, area) for t, hole, area, _ in found] == [
        ("a", False, 9.0), ("a", True, 1.0), ("b", False, 1.0), ("b", False, 1.0)
    ]
    # Counter-clockwise around, clockwise in the hole, from the smallest vertex on and back to it.
    assert found[0][3][:2] == [(0.0, 0.0), (1.0, 0.0)] and len(found[0][3]) == 13
    assert found[1][3] == [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]


def test_parts_that_meet_in_a_vertex_are_two_rings(spark):
    found = plain_rings(dissolve_rings(boxes(spark, [("a", 0, 0), ("a", 1, 1)]), "tract"))
    assert [(hole, area, len(ring)) for _, hole, area, ring in found] == [(False, 1.0, 5)] * 2


def test_a_dissolved_hole_stays_a_hole(spark):
    ring = "MULTIPOLYGON (((0 0, 0 9, 9 9, 9 0, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2)))"
    piece = spark.createDataFrame([("t", ring)], "geo_id STRING, wkt STRING")
    layer = boundaries_from_wkt(piece, "wkt").withColumn("tract", F.col("geo_id"))
    rings = plain_rings(dissolve_rings(layer, "tract"))
    assert [(hole, area) for _, hole, area, _ in rings] == [(False, 81.0), (True, 4.0)]
    points = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (8.0, 8.0)], "lon DOUBLE, lat DOUBLE")
    found = locate_points(points, dissolve_layer(layer, "tract").withColumnRenamed("tract", "geo_id"))
    assert sorted((r.lon, r.lat) for r in found.collect()) == [(1.0, 1.0), (8.0, 8.0)]


def test_no_pieces_and_overlapping_pieces(spark):
    assert dissolve_rings(boxes(spark, [("a", 0, 0)]).limit(0), "tract").count() == 0
    double = boxes(spark, [("a", 0, 0), ("a", 0, 0), ("a", 1, 0)])
    with pytest.raises(Exception, match="does not close"):
        dissolve_rings(double, "tract").collect()


def test_geojson_layers_are_merged(spark, tmp_path):
    shape = '{"type": "%s", "coordinates": %s}'
    feature = (
        '{"type": "Feature", "properties": {"STATEFP10": "%s", "COUNTYFP10": "001", '
        '"TRACTCE10": "000200"}, "geometry": %s}'
    )
    polygon = shape % ("Polygon", "[[[0, 0], [1, 0], [1, 1], [0, 0]]]")
    multi = shape % ("MultiPolygon", "[[[[5, 5], [6, 5], [6, 6], [5, 5]]], [[[7, 7], [8, 7], [8, 8], [7, 7]]]]")
    for name, state, geometry in (("a", "01", polygon), ("b", "02", multi)):
        text = '{"type": "FeatureCollection", "features": [\n' + feature % (state, geometry) + "]}"
        (tmp_path / f"{name}.json").write_text(text)
    layer = read_geojson(
        spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")],
        ["STATEFP10", "COUNTYFP10", "TRACTCE10"],
    )
    found = {r.fips: len(r.rings) for r in tract_ids(layer).collect()}
    assert found == {"01001000200": 1, "02001000200": 2}


def on_sphere(spark, wkt, points):
    layer = boundaries_from_wkt(spark.createDataFrame([(7, wkt)], "geo_id INT, shape STRING"), "shape")
    frame = spark.createDataFrame(points, "lon DOUBLE, lat DOUBLE")
    return {(r.lon, r.lat) for r in locate_on_sphere(frame, layer).collect()}


@pytest.mark.parametrize(
    ("wkt", "inside", "outside"),
    [
        # An edge along a parallel bulges towards the pole: the middle of 60 degrees at 50 north is at 54.0.
        ("POLYGON ((0 50, 60 50, 60 40, 0 40))", [(30.0, 53.9), (390.0, 53.9)], [(30.0, 54.1), (30.0, 43.0), (30.0, 91.0)]),
        # Across the antimeridian, in either way of writing it.
        ("POLYGON ((170 -5, -170 -5, -170 5, 170 5))", [(179.0, 0.0), (-179.0, 0.0), (180.0, 1.0), (-180.0, 1.0)], [(0.0, 0.0), (169.0, 0.0)]),
        ("POLYGON ((170 -5, 190 -5, 190 5, 170 5))", [(179.0, 0.0), (-179.0, 0.0), (181.0, 0.0)], [(0.0, 0.0), (-169.0, 0.0)]),
        # Around the poles, with the ring in either direction; a ring with the pole as a vertex.
        ("POLYGON ((0 60, 90 60, 180 60, -90 60))", [(10.0, 90.0), (0.0, 61.0), (45.0, 80.0)], [(45.0, 60.0), (0.0, 0.0), (0.0, -90.0)]),
        ("POLYGON ((0 -60, -90 -60, 180 -60, 90 -60))", [(10.0, -90.0), (0.0, -61.0)], [(45.0, -60.0), (0.0, 0.0), (0.0, 90.0)]),
        ("POLYGON ((0 90, 0 0, 90 0))", [(45.0, 45.0), (1.0, 89.0)], [(45.0, -1.0), (-1.0, 89.0), (91.0, 10.0)]),
        # A hole around the pole in a cap around it; points on vertices and edges.
        ("POLYGON ((0 60, 90 60, 180 60, -90 60), (0 80, 90 80, 180 80, -90 80))", [(0.0, 70.0)], [(0.0, 89.0), (0.0, 90.0), (0.0, 60.0)]),
        ("POLYGON ((0 0, 10 0, 10 10, 0 10))", [(5.0, 5.0)], [(0.0, 0.0), (5.0, 0.0), (0.0, 5.0), (10.0, 10.0)]),
    ],
)
def test_polygons_on_the_sphere(spark, wkt, inside, outside):
    assert on_sphere(spark, wkt, inside + outside) == set(inside)


def test_small_polygons_are_the_same_on_the_sphere(spark):
    """Many edges, hence strips; points far from the edges by more than an arc of this length bulges."""
    rng = random.Random(3)
    for cx in (-30.0, 178.5, -180.0):
        ring = [(cx + math.cos(t / 200 * math.tau) * (2 + t % 2), math.sin(t / 200 * math.tau) * (2 + t % 2)) for t in range(200)]
        wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"
        points = [(cx + rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(300)]
        expected = {(x, y) for x, y in points if crossings(x, y, [ring]) % 2}
        # Arcs of 0.1 degrees near the equator leave the straight line by far less than these points do.
        assert len(on_sphere(spark, wkt, points) ^ expected) == 0


def test_no_points_or_polygons_on_the_sphere(spark):
    assert on_sphere(spark, "POLYGON EMPTY", [(0.0, 0.0)]) == set()
    assert on_sphere(spark, "POLYGON ((0 0, 1 0, 1 1))", [(None, 0.5), (0.5, None)]) == set()


def test_areas_around_the_same_coordinates_are_one(spark):
    """Two shapes with the same points, one with other points as many, and a repeated row."""
    rows = [(x, 0.0, g, n) for g, n in (("a", "A"), ("b", "B")) for x in (1.0, 2.0)]
    rows += [(1.0, 0.0, "c", "C"), (3.0, 0.0, "c", "C"), (1.0, 0.0, "d", "D"), (1.0, 0.0, "d", "D"), (1.0, 0.0, "e", "E")]
    lookup = spark.createDataFrame(rows, "lon DOUBLE, lat DOUBLE, GEOID STRING, name STRING")
    around, members = alike(lookup)
    area = {r.GEOID: r.area.GEOID for r in members.collect()}
    assert area == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e"}
    assert around.count() == 2 + 2 + 2 + 1
    given = around.join(members, "area").select("lon", "lat", "GEOID", "name")
    assert as_set(given) == sorted(rows, key=repr)


def test_tests_meet_polygons_around_the_same_points_once(spark, monkeypatch):
    """Nested polygons around one point: their histograms are alike, and made once."""
    layer = spark.createDataFrame([(f"{i:05}", f"POLYGON ((0 0, {i} 0, {i} {i}, 0 {i}))") for i in range(1, 9)], "geo_id STRING, wkt STRING")
    layer = boundaries_from_wkt(layer, "wkt").withColumns({c: F.lit(c) for c in COUNTY_ATTRIBUTES})
    seen = []

    def counted(rows, *rest):
        seen.append(rows.count())
        return draw(rows, *rest)

    monkeypatch.setattr("netstats.plans.histograms.draw", counted)
    tests = frame_of(spark, both_directions([speed_test(i, i + 1.0, ip=f"10.0.0.{i}") for i in range(3)]))
    table = level_histogram("counties", prepare(tests), {"counties": layer})
    assert {(r.GEOID, r.dl_samples_day, r.dl_samples_bucket) for r in table.where("bucket_min = 0").collect()} == {(f"{i:05}", 3, 1) for i in range(1, 9)}
    assert seen == [6]


def test_histograms_are_worked_out_before_they_meet_polygons(spark):
    wkt = F.concat(F.lit("POLYGON ((0 0, "), F.col("id") + 9, F.lit(" 0, 9 9, 0 9, 0 0))"))
    layer = spark.range(3).select(F.col("id").alias("geo_id"), wkt.alias("wkt"))
    layer = boundaries_from_wkt(layer, "wkt").withColumns({c: F.lit(c) for c in COUNTY_ATTRIBUTES})
    rows = frame_of(spark, both_directions([speed_test(i, i + 1.0, ip=f"10.0.0.{i}") for i in range(4)]))
    table = level_histogram("counties", prepare(rows, rows_at_most=9), {"counties": layer})
    assert table.count() == 24
    # Without a shuffle between, Spark puts off the rounding and does it for each polygon.
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan[: plan.index("inline(array(")].split("Join", 1)[1]


@pytest.mark.parametrize("locate", [locate_points, locate_on_sphere])
def test_few_points_in_many_polygons_are_shared_out(spark, locate):
    """The pairs are the work, not the bytes of the points: these keep their tasks, and edges are tested as compiled rows."""
    wkt = F.format_string("POLYGON ((%d 0, %d 0, %d 30, %d 30))", *[F.col("id") % 50 + d for d in (0, 40, 40, 0)])
    layer = boundaries_from_wkt(spark.range(400).select(F.col("id").alias("geo_id"), wkt.alias("wkt")), "wkt")
    points = spark.range(300).select((F.col("id") % 90 + 0.5).alias("lon"), (F.col("id") % 29 + 0.5).alias("lat"))
    found = locate(points, layer)
    wanted = sum(r.lon > g % 50 and r.lon < g % 50 + 40 for r in points.distinct().collect() for g in range(400))
    assert found.count() == wanted
    assert found.rdd.getNumPartitions() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "filter(edges" not in plan and "exists(edges" not in plan


def test_edges_of_pieces_are_worked_out_once(spark):
    plan = _directed_outline(boxes(spark, [("a", 0, 0)]), "tract")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "size(flatten(" not in plan


def test_rounds_over_checkpointed_edges_are_not_broadcast(spark, monkeypatch):
    plans = []

    def kept(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return _checkpointed(rows)

    monkeypatch.setattr("netstats.operators.outlines._checkpointed", kept)
    assert dissolve_rings(boxes(spark, [("a", 0, 0), ("a", 1, 0), ("b", 3, 3)]), "tract").count() == 2
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans[1:])

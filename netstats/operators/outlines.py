"""Dissolving of polygons into closed rings, by list ranking over directed edges."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.functions.geometry import edges, within


def _checkpointed(rows: DataFrame) -> DataFrame:
    """The same rows, kept in the folder that all executors share, so that rounds do not pile up in the plan."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            given = tempfile.mkdtemp(prefix="netstats-")
        spark.sparkContext.setCheckpointDir(given)
    return rows.checkpoint()


def twice_area(ring: Column) -> Column:
    """Twice the signed area of a ring; positive where it runs counter-clockwise."""
    return F.aggregate(
        edges(F.array(ring)), F.lit(0.0), lambda total, e: total + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )


def oriented(rings: Column) -> Column:
    """The rings of a polygon, turned so that its inside lies to their left.

    A ring within an odd number of others is a hole. The middle of its first edge decides, since rings of one polygon may
    meet in vertices only.
    """

    def turned(ring: Column) -> Column:
        e = F.get(edges(F.array(ring)), F.lit(0))
        x, y = (e["x1"] + e["x2"]) / 2, (e["y1"] + e["y2"]) / 2
        around = F.filter(rings, lambda other: within(x, y, edges(F.array(other))))
        # Most polygons are one ring, which is no hole; no other ring needs to be looked at then.
        outer = (F.size(rings) == 1) | (F.size(around) % 2 == 0)
        return F.when((twice_area(ring) > 0) == outer, ring).otherwise(F.reverse(ring))

    return F.transform(rings, turned)


def _directed_outline(pieces: DataFrame, by: str) -> DataFrame:
    """(by, a, b): edges of one piece only, from a to b, with the inside to their left."""
    # `explode` would work the edges out three times, since Spark first looks whether there are any.
    parts = pieces.select(by, F.explode_outer(edges(oriented(F.col("rings")))).alias("e")).where("e IS NOT NULL")
    a = F.struct(F.col("e.x1").alias("x"), F.col("e.y1").alias("y"))
    b = F.struct(F.col("e.x2").alias("x"), F.col("e.y2").alias("y"))
    return (
        parts.select(by, F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), (a < b).alias("up"))
        .groupBy(by, "low", "high")
        .agg(F.count(F.lit(1)).alias("uses"), F.bool_and("up").alias("up"))
        .where("uses = 1")
        .select(
            by,
            F.when(F.col("up"), F.col("low")).otherwise(F.col("high")).alias("a"),
            F.when(F.col("up"), F.col("high")).otherwise(F.col("low")).alias("b"),
        )
    )


def _followed(outline: DataFrame, by: str) -> DataFrame:
    """(by, id, jump): each edge and the one after it, which is that with the sharpest turn to the left."""
    following = outline.select(by, F.col("a").alias("b"), F.col("b").alias("c"))
    dx1, dy1 = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    dx2, dy2 = F.col("c.x") - F.col("b.x"), F.col("c.y") - F.col("b.y")
    turn = F.atan2(dx1 * dy2 - dy1 * dx2, dx1 * dx2 + dy1 * dy2)
    best = (
        outline.join(following, [by, "b"], "left")
        .groupBy(by, "a", "b")
        .agg(F.max(F.struct(turn.alias("turn"), "c")).alias("best"))
    )
    closed = F.when(F.col("best.c").isNotNull(), F.struct(F.col("b").alias("a"), F.col("best.c").alias("b")))
    open_end = F.raise_error(F.concat(F.lit("an outline does not close, pieces overlap: "), F.col(by).cast("string")))
    return best.select(by, F.struct("a", "b").alias("id"), F.coalesce(closed, open_end).alias("jump"))


def _ranked(follows: DataFrame, by: str) -> DataFrame:
    """(by, id, lead, away): the smallest edge of each edge's ring, and how many steps ahead it is.

    Pointer doubling: after k rounds an edge knows the smallest of the 2^k edges from it on. When a round changes nothing,
    these cover whole rings. Rounds are the logarithm of the longest ring; a round is one join by edge. What Spark
    knows of the size of checkpointed rows is a guess from the input's files, far too small, so it is told not to broadcast them.
    """
    state = _checkpointed(follows.select(by, "id", "jump", F.col("id").alias("lead"), F.lit(0).cast("bigint").alias("away")))
    step = 1
    while True:
        ahead = state.select(
            by, F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("lead").alias("lead2"), F.col("away").alias("away2")
        )
        better = F.col("lead2") < F.col("lead")
        state = _checkpointed(
            state.join(ahead.hint("merge"), [by, "jump"]).select(
                by,
                "id",
                F.col("next").alias("jump"),
                F.when(better, F.col("lead2")).otherwise(F.col("lead")).alias("lead"),
                F.when(better, F.col("away2") + step).otherwise(F.col("away")).alias("away"),
                better.alias("changed"),
            )
        )
        step *= 2
        if state.where("changed").isEmpty():
            return state.select(by, "id", "lead", "away")


def dissolve_rings(pieces: DataFrame, by: str) -> DataFrame:
    """(by, hole, area, ring): the closed rings around the union of the polygons that share `by`.

    Pieces must fit together edge to edge: a shared edge has the same two ends in both. Outer rings run counter-clockwise and
    holes clockwise; each starts at its smallest vertex, which it repeats at its end. Where parts meet in one vertex, the
    sharpest turn to the left is taken: two parts become two rings, and a hole that touches the ring around it becomes part of
    that. The even-odd test gives the same either way. Pieces that overlap leave ends open, which is an error. Rows without a
    `by` have no outline. No rows give no rings.
    """
    known = pieces.where(F.col(by).isNotNull())
    ranked = _ranked(_followed(_directed_outline(known, by), by), by)
    # From the smallest edge on, the way back to it gets shorter.
    place = F.when(F.col("away") == 0, F.lit(None)).otherwise(-F.col("away")).alias("place")
    rings = ranked.groupBy(by, "lead").agg(
        F.sort_array(F.collect_list(F.struct(place, F.col("id.a").alias("at")))).alias("steps")
    )
    at = F.transform("steps", lambda s: s["at"])
    area = twice_area(F.col("ring")) / 2
    return rings.select(by, F.concat(at, F.slice(at, 1, 1)).alias("ring")).select(
        by, (area < 0).alias("hole"), F.abs(area).alias("area"), "ring"
    )


def dissolve_layer(pieces: DataFrame, by: str) -> DataFrame:
    """(by, rings): the dissolved polygons as a layer like the one they came from."""
    return dissolve_rings(pieces, by).groupBy(by).agg(F.collect_list("ring").alias("rings"))

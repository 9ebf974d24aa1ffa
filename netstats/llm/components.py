"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstats.llm.shared import cut


def _mark(edges: DataFrame) -> tuple:
    """Two equal marks mean equal edge sets."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each end of `links` (a, b); root is the smallest node of the component.

    Each round hangs the neighbours of a node below the smallest of them, first the larger
    neighbours, then the smaller ones. Minima are combined before each shuffle; a node with very many
    neighbours meets them in a join, whose large partitions adaptive execution splits. Rounds grow
    with the logarithm of the longest path. Links of a node to itself are ignored; no links give no rows.
    """
    a, b = F.col("a"), F.col("b")
    edges = cut(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

"""Shards of near equal bytes by Karmarkar-Karp differencing over indivisible groups."""

from __future__ import annotations

import heapq
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstats.llm.shared import cut

#: Bundles of small groups, and a bound on the number of large groups, that are differenced.
ITEMS = 4096


def differencing(parts: np.ndarray) -> np.ndarray:
    """Combines partial partitions until one is left.

    `parts` has a row for each partial partition: the bytes of its shards, in any order. Returned is, for each of
    these, the place in the combined partition (0 the largest). The two with the largest spread are combined
    again and again, the largest shard of one with the smallest of the other.
    """
    n, k = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, axis=1))
    heap = [(-int(x[0] - x[-1]), i) for i, x in enumerate(sums)]
    heapq.heapify(heap)
    made = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        new = np.argsort(-both, kind="stable")
        made.append((a, b, new))
        sums[a] = sums[b] = None
        both = both[new]
        sums.append(both)
        heapq.heappush(heap, (-int(both[0] - both[-1]), len(sums) - 1))
    place: list[np.ndarray | None] = [None] * len(sums)
    place[-1] = np.arange(k)
    for i in range(len(made) - 1, -1, -1):
        a, b, new = made[i]
        to = np.empty(k, np.int64)
        to[new] = place[n + i]  # of the shards as they were before they were ordered
        place[a], place[b], place[n + i] = to, to[::-1], None
    out = np.empty((n, k), np.int64)
    for i in range(n):
        out[i, order[i]] = place[i]
    return out


def balanced(groups: DataFrame, shards: int, items: int = ITEMS) -> tuple[DataFrame, DataFrame]:
    """Shards of the `groups` (node long, bytes long): (node, shard) of large ones, (bundle, shard) of the others.

    A group is large if it has more than a part in `items` of all bytes, so fewer than `items` are. All others are
    bundled by hash into `items` bundles. One task then differences these at most 2 * `items` weights, whatever the
    input; so many weights leave a spread far below the smallest of them, unless one exceeds a shard's share.
    """
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * items > total

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["large", "node"], kind="stable").reset_index(drop=True)
        parts = np.zeros((len(rows), shards), np.int64)
        parts[:, 0] = rows["bytes"]
        return pd.DataFrame({"large": rows["large"], "node": rows["node"], "shard": differencing(parts)[:, 0]})

    weights = groups.select(
        large.alias("large"), F.when(large, F.col("node")).otherwise(bundle(F.col("node"), items)).alias("node"), "bytes"
    )
    weights = weights.groupBy("large", "node").agg(F.sum("bytes").alias("bytes"))
    placed = weights.withColumn("all", F.lit(True)).groupBy("all").applyInPandas(run, "large boolean, node long, shard int")
    placed = cut(placed)
    return (
        placed.where("large").select("node", F.col("shard").alias("own_shard")),
        placed.where("NOT large").select(F.col("node").alias("bundle"), F.col("shard").alias("bundle_shard")),
    )


def bundle(node: Column, items: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(items)).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int, overhead: int = 8, items: int = ITEMS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of `docs`.

    The law is `bytes`: shards are near equal in bytes, and equal texts, a group, share a shard. A group is
    never divided, so one with more bytes than a shard's share fills a shard beyond it. The size of a row is the bytes
    of its text plus `overhead`; null counts as the empty text. Slots count the rows of a shard from 0 without gaps, in no
    meaningful order; repeated rows get a slot each. grown_shard is null: it belongs to another law.
    Fewer groups than shards leave shards empty. No rows give no rows.

    Texts are compared by 60 bits of MD5; should these collide, both texts share a shard, which costs balance only.
    Sizes are summed before the shuffle, and the rows meet their shards by broadcast of at most 2 * `items` numbers.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        (F.octet_length("text") + overhead).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("node"),
    )
    groups = cut(rows.groupBy("node").agg(F.sum("size").alias("bytes")))
    own, bundled = balanced(groups, shards, items)
    dealt = (
        rows.withColumn("bundle", bundle(F.col("node"), items))
        .join(F.broadcast(own), "node", "left")
        .join(F.broadcast(bundled), "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "bundle_shard").alias("shard"))
    )
    return numbered(dealt).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(dealt: DataFrame) -> DataFrame:
    """Adds `slot`: rows are numbered within each task's part of a shard, and the parts' sizes give their offsets."""
    binned = cut(dealt.withColumn("bin", F.spark_partition_id()))
    sizes = binned.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size")
    return (
        binned.withColumn("rn", F.row_number().over(inside))
        .join(starts, ["shard", "bin"])
        .withColumn("slot", F.col("start") + F.col("rn") - 1)
        .drop("bin", "rn", "start")
    )

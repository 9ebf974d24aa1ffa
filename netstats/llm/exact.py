"""Exact duplicates by 128-bit content hash, with bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.llm.decontaminate import bounded
from netstats.llm.shared import cut

#: The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def content_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of `docs`.

    Rows are grouped by the MD5 of the squeezed text. Where a group has several rows, the smallest and the
    largest squeezed text of the group are compared, byte by byte; if they differ, the hash has collided and
    SHA-256 divides the group. All aggregates are combined before the shuffle, so a group
    with a third of all rows arrives as a few rows per task. The row with the most code points stays, then the
    smallest doc_id (null after all others); of rows equal in both, all are marked kept. No rows give no rows.

    Hashes and lengths are kept in the shared folder, so texts are read twice: to be hashed, and for the comparison, to which only those
    of repeated hashes go. Texts are not shuffled for that while the repeated hashes are few enough to be broadcast.
    """
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).select(
        "doc_id", F.length("text").cast("long").alias("n"), squeezed(text).alias("norm")
    )
    hashed = rows.withColumn("h", F.unhex(F.md5("norm")))
    keyed = cut(hashed.select("doc_id", "n", "h", F.unhex(F.sha2("norm", 256)).alias("digest")))
    repeated = bounded(cut(keyed.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")))
    collided = (
        hashed.select("h", "norm")
        .join(repeated, "h", "left_semi")
        .groupBy("h")
        .agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
        .where("low <> high")
        .select("h", F.lit(True).alias("apart"))
    )
    keyed = keyed.join(collided, "h", "left").withColumn("own", F.when(F.col("apart"), F.col("digest")))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    groups = keyed.groupBy("h", "own").agg(best.alias("best"), F.count("*").alias("group_size"))
    left, right = keyed.alias("l"), groups.alias("r")
    return left.join(right, (F.col("l.h") == F.col("r.h")) & F.col("l.own").eqNullSafe(F.col("r.own"))).select(
        "l.doc_id",
        F.col("r.best.id").alias("keep_id"),
        "r.group_size",
        (F.col("l.doc_id").eqNullSafe(F.col("r.best.id")) & (-F.col("l.n") == F.col("r.best.less"))).alias("kept"),
        F.lower(F.hex("l.digest")).alias("text_sha256"),
    )

"""Repeatable 60-bit fingerprints of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60


def fingerprint(text: Column, method: str = "md5") -> Column:
    """Non-negative fingerprint of a string column, evenly spread over 60 bits.

    'md5' can be computed by any SQL engine, which makes results portable;
    'xxhash64' is several times cheaper and stays within Spark.
    """
    if method == "md5":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    if method == "xxhash64":
        hashed = F.xxhash64(text).bitwiseAND(F.lit((1 << BITS) - 1))
        return F.when(text.isNotNull(), hashed)
    raise ValueError(f"unknown fingerprint method: {method}")


def slice_of(fp: Column, slices: Column) -> Column:
    """Index of the equal slice of the fingerprint space that `fp` falls in (order-preserving).

    NULL sorts first and so belongs to the first slice.
    """
    at = F.floor(F.coalesce(fp, F.lit(0)).cast("double") / F.lit(float(1 << BITS)) * slices)
    return F.least(at, slices - 1).cast("bigint")


def shard(text: Column, shards: int) -> Column:
    return F.pmod(fingerprint(text.cast("string")), F.lit(shards)).cast("bigint")

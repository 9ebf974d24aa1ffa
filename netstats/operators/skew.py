"""Checks and joins that keep one hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys; Spark still plans it as an equi-join."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on keys where NULL equals NULL; the keys appear once, from the left.

    This is also how rows meet a lookup whose keys are hot in them. It needs no look at the data
    first: at run time Spark broadcasts a small lookup, and divides the large partitions of
    a shuffled join.
    """
    other = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(Column.__and__, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    joined = left.join(other, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(
        *[f"_right_{k}" for k in keys]
    )


def hot_groups(
    df: DataFrame, keys: Sequence[str], limit: int, counted_as: str = "tests"
) -> DataFrame | None:
    """Groups with more than `limit` rows, or None. There are at most rows/limit of them."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(counted_as))
    hot = sizes.where(F.col(counted_as) > limit).persist(StorageLevel.MEMORY_AND_DISK)
    # Several steps read them; a look at the first rows only would leave each of these to find the rest at the same time.
    if hot.count() == 0:
        hot.unpersist()
        return None
    return hot


def split_hot(
    df: DataFrame, hot: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups with the group's row count)."""
    marked = join_null_safe(df, hot, keys, "left")
    counted = next(c for c in hot.columns if c not in keys)
    return marked.where(F.col(counted).isNull()).drop(counted), marked.where(
        F.col(counted).isNotNull()
    )


@dataclass(frozen=True)
class Profile:
    """Proven bounds on group sizes of a set of cleaned rows.

    At every level an address gives one sample per day, direction and geography.
    So no geography has more samples than its day and direction has addresses,
    and no (geography, address) group has more tests than the address has.
    """

    tests_per_address: int
    addresses_per_day: int


def profile(cleaned: DataFrame) -> Profile:
    """One scan of three columns, combined before each shuffle; returns one row."""
    per_address = cleaned.groupBy("date", "direction", "ip").agg(F.count(F.lit(1)).alias("tests"))
    per_day = per_address.groupBy("date", "direction").agg(
        F.count(F.lit(1)).alias("addresses"), F.max("tests").alias("tests")
    )
    row = per_day.agg(F.max("tests").alias("tests"), F.max("addresses").alias("n")).first()
    return Profile(row["tests"] or 0, row["n"] or 0)

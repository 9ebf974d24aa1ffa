"""Sequence numbers and counts within groups, also where one group is huge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstats.functions.fingerprint import slice_of
from netstats.limits import DEFAULT, Limits
from netstats.operators.skew import hot_groups, join_null_safe, split_hot


def number(
    rows: DataFrame,
    groups: Mapping[str, Sequence[str]],
    coarse: Sequence[str],
    size: str,
    limits: Limits = DEFAULT,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Add `<name>Sample` and `<name>Count` for each named group.

    Samples are numbered by `size` descending, then by the fingerprint `fp`. The
    columns `coarse` are part of every group, so a group is never larger than its
    coarse group; only where one of those is too large for a task are the numbers
    put together from slices.
    """
    if rows_at_most is not None and rows_at_most <= limits.tests_per_group:
        return _by_window(rows, groups, size, coarse)
    hot = hot_groups(rows, coarse, limits.tests_per_group, "_group_rows")
    if hot is None:
        return _by_window(rows, groups, size, coarse)
    ordinary, large = split_hot(rows, hot, coarse)
    slices = F.ceil(F.col("_group_rows") / F.lit(limits.tests_per_group))
    large = large.withColumn("_slice", slice_of(F.col("fp"), slices)).drop("_group_rows")
    # Sizes of the slices of all groups come from one count, not each from the rows as the groups before left them.
    fine = [*dict.fromkeys(c for keys in groups.values() for c in keys), size, "_slice"]
    counts = large.groupBy(*fine).agg(F.count(F.lit(1)).alias("_rows"))
    for name, keys in groups.items():
        large = _by_slices(large, counts, name, keys, size)
    return _by_window(ordinary, groups, size, coarse).unionByName(large.drop("_slice"))


def _order(size: str) -> list[Column]:
    return [F.col(size).desc(), F.col("fp")]


def _by_window(
    rows: DataFrame, groups: Mapping[str, Sequence[str]], size: str, coarse: Sequence[str]
) -> DataFrame:
    """Rows are brought together once, by what all groups have in common."""
    rows = rows.repartition(*coarse)
    for name, keys in groups.items():
        together = Window.partitionBy(*keys)
        rows = rows.withColumn(
            f"{name}Sample", F.row_number().over(together.orderBy(*_order(size)))
        ).withColumn(f"{name}Count", F.count(F.lit(1)).over(together))
    return rows


def _by_slices(rows: DataFrame, counts: DataFrame, name: str, keys: Sequence[str], size: str) -> DataFrame:
    """Numbers within a slice, plus the number of rows in the slices before it."""
    place = [*keys, size, "_slice"]
    together = Window.partitionBy(*keys)
    upto = together.orderBy(F.col(size).desc(), "_slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = (
        counts.groupBy(*place)
        .agg(F.sum("_rows").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
        .withColumn(f"{name}Count", F.sum("_rows").over(together))
        .drop("_rows")
    )
    within = Window.partitionBy(*place).orderBy("fp")
    return (
        join_null_safe(rows, offsets, place)
        .withColumn(f"{name}Sample", (F.col("_before") + F.row_number().over(within)).cast("int"))
        .drop("_before")
    )

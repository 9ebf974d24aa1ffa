"""Two repeatable draws per address.

The tests of an address on one day are put in the arbitrary but repeatable order
of their fingerprints, and the tests at two fixed positions are drawn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstats.functions.fingerprint import slice_of
from netstats.limits import DEFAULT, Limits
from netstats.operators.skew import join_null_safe, split_hot

# The two primes whose remainder by the number of tests is drawn.
FIRST = 511232941
SECOND = 906686609

ORDER = ["fp", "mbps", "MinRTT"]


def _positions(tests: Column) -> tuple[Column, Column]:
    return F.lit(FIRST) % tests, F.lit(SECOND) % tests


def draw(
    rows: DataFrame,
    keys: Sequence[str],
    hot_addresses: DataFrame | None = None,
    limits: Limits = DEFAULT,
    parts: int | None = None,
) -> DataFrame:
    """Drawn rows: group columns, tests, mbps, MinRTT, is_first, is_second.

    Groups are (date, direction, keys, ip); each gives one row, or two when its
    draws differ. `hot_addresses` lists the (date, direction, ip) that have too many
    tests for one task, with their number. `parts` is the number of tasks, if not Spark's.
    """
    group = ["date", "direction", *keys, "ip"]
    if hot_addresses is None:
        return _draw_by_sorting(rows, group, parts)
    # Only the rows of hot addresses take the longer way.
    ordinary, hot = split_hot(rows, hot_addresses, ["date", "direction", "ip"])
    drawn = _draw_by_sorting(ordinary, group, parts)
    return drawn.unionByName(_draw_by_slices(hot, group, limits).select(drawn.columns))


def _draw_by_sorting(rows: DataFrame, group: list[str], parts: int | None = None) -> DataFrame:
    """One shuffle and one sort; each group is sorted within a task."""
    if parts is not None:
        rows = rows.repartition(parts, *group)
    together = Window.partitionBy(*group)
    placed = rows.select(
        *group,
        "mbps",
        "MinRTT",
        (F.row_number().over(together.orderBy(*ORDER)) - 1).alias("place"),
        F.count(F.lit(1)).over(together).alias("tests"),
    )
    first, second = _positions(F.col("tests"))
    return (
        placed.withColumn("is_first", F.col("place") == first)
        .withColumn("is_second", F.col("place") == second)
        .where(F.col("is_first") | F.col("is_second"))
        .drop("place")
    )


def _draw_by_slices(rows: DataFrame, group: list[str], limits: Limits) -> DataFrame:
    """The same draws for groups of any size.

    A group is cut into slices of the fingerprint space: as many as the tests of its address, whose number
    `tests` has, ask for. Rows without a fingerprint come first in the order, in slices of the speed: the
    negative ones. The sizes of the slices tell which one holds the wanted position, and only that
    slice is sorted. Copies of a row are counted, not carried.
    """
    slices = F.ceil(F.col("tests") / F.lit(limits.tests_per_group))
    # Grows with the speed, from 0 to 1; half of it at ten.
    level = F.greatest(F.coalesce("mbps", F.lit(0.0)), F.lit(0.0)) / (F.greatest(F.coalesce("mbps", F.lit(0.0)), F.lit(0.0)) + 10)
    unknown = F.least(F.floor(level * slices), slices - 1) - slices
    distinct = (
        rows.withColumn("slice", F.when(F.col("fp").isNull(), unknown).otherwise(slice_of(F.col("fp"), slices)))
        .groupBy(*group, "slice", *ORDER)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    sizes = distinct.groupBy(*group, "slice").agg(F.sum("copies").alias("size"))
    together = Window.partitionBy(*group)
    upto = together.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, second = _positions(F.col("tests"))
    before, through = F.col("before"), F.col("before") + F.col("size")
    wanted = (
        sizes.withColumn("before", F.sum("size").over(upto) - F.col("size"))
        .withColumn("tests", F.sum("size").over(together))
        .where(((first >= before) & (first < through)) | ((second >= before) & (second < through)))
        .drop("size")
    )
    inside = Window.partitionBy(*group, "slice").orderBy(*ORDER)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high = F.col("last") - F.col("copies"), F.col("last")
    return (
        join_null_safe(distinct, wanted, [*group, "slice"])
        .withColumn("last", F.col("before") + F.sum("copies").over(running))
        .withColumn("is_first", (first >= low) & (first < high))
        .withColumn("is_second", (second >= low) & (second < high))
        .where(F.col("is_first") | F.col("is_second"))
        .select(*group, "mbps", "MinRTT", "tests", "is_first", "is_second")
    )


def pair(drawn: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group with both draws side by side."""

    def only(flag: str, column: str) -> Column:
        return F.max(F.when(F.col(flag), F.col(column)))

    return drawn.groupBy("date", "direction", *keys, "ip").agg(
        F.max("tests").alias("tests"),
        only("is_first", "mbps").alias("mbps_rnd1"),
        only("is_first", "MinRTT").alias("MinRTT_rnd1"),
        only("is_second", "mbps").alias("mbps_rnd2"),
        only("is_second", "MinRTT").alias("MinRTT_rnd2"),
    )

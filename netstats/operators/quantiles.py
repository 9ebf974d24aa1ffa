"""Exact quantiles, by sorting groups or by narrowing intervals of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netstats.functions.numbers import quoted
from netstats.operators.skew import join_null_safe


@dataclass(frozen=True)
class Quantile:
    """The smallest value of a series whose rank is at least part/whole of the count."""

    series: str
    part: int
    whole: int


def with_ranks(rows: DataFrame, by: Sequence[str], series: Sequence[str]) -> DataFrame:
    """Add `_rank_<series>` and `_n_<series>` within each group; NULLs come last.

    One sort per series and no buffer that grows with a group, as long as the rows
    of a group may be sorted by one task.
    """
    together = Window.partitionBy(*by)
    for s in series:
        rows = rows.withColumn(
            f"_rank_{s}", F.row_number().over(together.orderBy(F.col(s).asc_nulls_last()))
        ).withColumn(f"_n_{s}", F.count(s).over(together))
    return rows


def ranked_value(pick: Quantile, condition: str = "true") -> str:
    """Aggregate (as SQL text) that reads a quantile off rows ranked by `with_ranks`."""
    s = pick.series
    # In whole numbers, so that no rank is missed by a rounding error.
    wanted = f"(_n_{s} * {pick.part} + {pick.whole - 1}) div {pick.whole}"
    return f"max(CASE WHEN {condition} AND _rank_{s} = greatest({wanted}, 1) THEN {quoted(s)} END)"


#: Bins that an interval of values is cut into, and how often. That tells apart BINS ** PASSES values.
BINS, PASSES = 1 << 16, 2


def selected_quantiles(
    rows: DataFrame, keys: Sequence[str], picks: Mapping[str, Quantile], digits: Mapping[str, int]
) -> DataFrame:
    """Quantiles rounded to the `digits` of their series, for groups of any size, all at once.

    Rounding keeps order, so quantiles can be read from a count of rounded values, as whole numbers. These are
    counted with the value in the shuffle key, which spreads a hot group evenly. Then the interval that holds
    a wanted rank is narrowed: cut into BINS equal bins, whose counts tell which one holds the
    rank and how much of it lies before. No task meets more of a group than its bins. Values are finite, and the
    largest and smallest of a group differ by less than BINS ** PASSES units of the last digit; else the job fails.
    """
    series = sorted({p.series for p in picks.values()})
    whole = {s: F.round(F.round(s, digits[s]) * 10 ** digits[s]).cast("bigint") for s in series}
    values = F.array(*[F.struct(F.lit(s).alias("_series"), whole[s].alias("_value")) for s in series])
    group = [*keys, "_series"]
    counted = (
        rows.select(*keys, F.inline(values))
        .where(F.col("_value").isNotNull())
        .groupBy(*group, "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    wanted = F.array(
        *[
            F.struct(*[F.lit(x).alias(n) for n, x in (("_of", q.series), ("_name", name), ("_part", q.part), ("_whole", q.whole))])
            for name, q in picks.items()
        ]
    )
    total = F.sum("_rows").alias("_total")
    spans = counted.groupBy(*group).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), total)
    state = spans.select("*", F.inline(wanted)).where("_of = _series").select(
        *group,
        "_name",
        "_low",
        (F.col("_high") - F.col("_low") + 1).alias("_width"),
        F.expr("greatest((_total * _part + _whole - 1) div _whole, 1)").alias("_rank"),
    )
    for _ in range(PASSES):
        state = _narrowed(counted, state, group)
    far = F.raise_error(F.lit(f"values of a group differ by more than {BINS}^{PASSES} units"))
    value = F.when(F.col("_width") > 1, far.cast("bigint")).otherwise(F.col("_low"))
    scale = F.create_map(*[x for s in series for x in (F.lit(s), F.lit(float(10 ** digits[s])))])
    found = state.select(*keys, "_name", (value / scale[F.col("_series")]).alias("_value"))
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in picks]
    )


def _narrowed(counted: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """Each interval of `state` cut down to the bin that holds its rank; the rank is now that within the bin."""
    each = [*group, "_name", "_low", "_width", "_rank"]
    inside = F.col("_value").between(F.col("_low"), F.col("_low") + F.col("_width") - 1)
    step = f"((_width + {BINS - 1}) div {BINS})"
    bins = (
        join_null_safe(counted, state, group)
        .where(inside)
        .groupBy(*each, F.expr(f"(_value - _low) div {step}").alias("_bin"))
        .agg(F.sum("_rows").alias("_rows"))
        .groupBy(*each)
        .agg(F.array_sort(F.collect_list(F.struct("_bin", "_rows"))).alias("_bins"))
    )
    # Ranks are passed over bin by bin until one holds what is left.
    found = F.expr(
        "aggregate(_bins, named_struct('left', _rank, 'bin', -1L), (a, x) -> CASE WHEN a.bin >= 0 THEN a "
        "WHEN a.left <= x._rows THEN named_struct('left', a.left, 'bin', x._bin) "
        "ELSE named_struct('left', a.left - x._rows, 'bin', -1L) END)"
    )
    return bins.withColumn("_found", found).selectExpr(
        *[f"`{c}`" for c in group],
        "_name",
        f"_low + _found.bin * {step} AS _low",
        f"{step} AS _width",
        "_found.left AS _rank",
    )

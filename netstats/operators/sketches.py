"""Mergeable sketches kept for each day and group: quantiles (KLL) and numbers of different values (HLL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.schema import DIRECTIONS

#: Size parameter of a sketch. Up to about so many values it is exact; beyond, the rank of a quantile is off by no more
#: than RANK_ERROR of the count (with 99 % confidence by a fifth of that), and the sketch stays at some tens of kilobytes.
K, RANK_ERROR = 1024, 0.015

#: Columns with a sketch each: direction and value.
SERIES = {f"{short}_{column}": (short, column) for short in DIRECTIONS for column in ("mbps", "MinRTT")}


def sketch_of(name: str) -> Column:
    """Aggregate: the sketch of a series of the first draws. Combined before the shuffle."""
    short, column = SERIES[name]
    value = F.when((F.col("direction") == short) & F.col("is_first"), F.col(column))
    return F.kll_sketch_agg_double(value, K).alias(f"{name}_sketch")


def daily_sketches(drawn: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (date, keys) with a sketch of each series: a table that can be kept and merged."""
    return drawn.groupBy("date", *keys).agg(*[sketch_of(name) for name in SERIES])


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of `by`, from those of finer groups, such as the days of a month."""
    return sketches.groupBy(*by).agg(
        *[F.kll_merge_agg_double(f"{name}_sketch").alias(f"{name}_sketch") for name in SERIES]
    )


def samples(name: str) -> Column:
    """Values that a sketch stands for, exactly."""
    return F.kll_sketch_get_n_double(f"{name}_sketch")


def quantile(name: str, part: int, whole: int) -> Column:
    """A value whose rank is about part/whole of the count; NULL without values."""
    found = F.kll_sketch_get_quantile_double(f"{name}_sketch", F.lit(part / whole))
    return F.when(samples(name) > 0, found)


#: Binary logarithm of a counting sketch's registers, and how far a count may be off: about four standard errors.
LOG_REGISTERS, COUNT_ERROR = 12, 0.065


def daily_counters(rows: DataFrame, by: Sequence[str], of: str) -> DataFrame:
    """One row per `by` with `of_counter`, a sketch of the different values of `of`; NULL values are not counted.

    A sketch has at most some kilobytes, whatever the number of values, and is combined before the shuffle, where an exact
    count of different values would shuffle each of them.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(of, F.lit(LOG_REGISTERS)).alias(f"{of}_counter"))


def merged_counters(counters: DataFrame, by: Sequence[str], of: str) -> DataFrame:
    """The counters of `by` from those of finer groups. A value that several of them hold counts once."""
    return counters.groupBy(*by).agg(F.hll_union_agg(f"{of}_counter").alias(f"{of}_counter"))


def counted(of: str) -> Column:
    """About how many different values a counter has seen."""
    return F.hll_sketch_estimate(f"{of}_counter")

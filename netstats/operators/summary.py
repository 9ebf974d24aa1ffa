"""Daily statistics and histograms of both directions in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.functions import buckets
from netstats.functions.numbers import log_mean, plain_round, quoted, steady_round
from netstats.operators import sketches
from netstats.operators.quantiles import (
    Quantile,
    ranked_value,
    selected_quantiles,
    with_ranks,
)
from netstats.schema import BUCKET_COLUMNS, DIRECTIONS, daily_columns

# The published quartile columns are the 24th, 49th and 74th
# percentiles; 'documented' gives the ones their description names. 'sketch' gives
# about the published ones, from mergeable sketches.
QUARTILES = {"published": (24, 49, 74), "documented": (25, 50, 75), "sketch": (24, 49, 74)}


def _plain_aggregates(short: str) -> dict[str, str]:
    """Everything but the quantiles of one direction, as SQL texts."""
    long = DIRECTIONS[short]
    first = f"direction = '{short}' AND is_first"
    second = f"direction = '{short}' AND is_second"

    def of(column: str, drawn: str) -> str:
        return f"CASE WHEN {drawn} THEN {column} END"

    mbps = of("mbps", first)
    named = {
        f"{short}_samples_day": f"count_if({first})",
        f"{short}_LOG_AVG_rnd1": log_mean("mbps", first),
        f"{short}_LOG_AVG_rnd2": log_mean("mbps", second),
        f"{short}_minRTT_LOG_AVG_rnd1": log_mean("MinRTT", first),
        f"{short}_minRTT_LOG_AVG_rnd2": log_mean("MinRTT", second),
        f"{long}_MIN": f"min({mbps})",
        f"{long}_AVG": f"avg({mbps})",
        f"{long}_MAX": f"max({mbps})",
    }
    for i in range(len(buckets.EDGES)):
        named[f"_{short}_bucket{i}"] = f"count_if({first} AND bucket = {i})"
    return named


def _quantiles(short: str, quartiles: str) -> dict[str, Quantile]:
    long = DIRECTIONS[short]
    q25, median, q75 = QUARTILES[quartiles]
    return {
        f"{long}_Q25": Quantile("mbps", q25, 100),
        f"{long}_MED": Quantile("mbps", median, 100),
        f"{long}_Q75": Quantile("mbps", q75, 100),
        f"{long}_minRTT_MED": Quantile("MinRTT", median, 100),
    }


def daily_statistics(
    drawn: DataFrame, keys: Sequence[str], quartiles: str = "published", spread: bool = False, parts: int | None = None
) -> DataFrame:
    """One row per (date, keys) that has samples in both directions.

    Bucket counts stay as columns `_dl_bucket0` ... until `histogram` unfolds them.
    One shuffle brings a geography's day together, and ranks, statistics and counts
    are all taken there. With `spread` nothing is brought together before it is
    aggregated, for geographies with very many samples. With `quartiles` 'sketch' neither is it, and
    quantiles come from sketches that the same aggregation makes: one shuffle of small rows, no sort. `parts` is the
    number of tasks that sort, if not Spark's.
    """
    by = ["date", *keys]
    plain = {k: v for short in DIRECTIONS for k, v in _plain_aggregates(short).items()}
    rows = drawn.withColumn("bucket", F.expr(buckets.bucket_of("mbps")))
    if quartiles == "sketch":
        stats = rows.groupBy(*by).agg(*_aliased(plain), *[sketches.sketch_of(s) for s in sketches.SERIES])
        picks = {k: (f"{s}_{q.series}", q) for s in DIRECTIONS for k, q in _quantiles(s, quartiles).items()}
        stats = stats.withColumns({k: sketches.quantile(name, q.part, q.whole) for k, (name, q) in picks.items()})
    elif spread:
        # Read for the statistics and for the quantiles, and dear to draw.
        drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)
        rows = drawn.withColumn("bucket", F.expr(buckets.bucket_of("mbps")))
        stats = rows.groupBy(*by).agg(*_aliased(plain))
        columns = {f"{s}_{c}": (s, c) for s in DIRECTIONS for c in ("mbps", "MinRTT")}
        values = drawn.where("is_first").selectExpr(
            *map(quoted, by),
            *[f"CASE WHEN direction = '{s}' THEN {c} END AS {n}" for n, (s, c) in columns.items()],
        )
        picks = {
            name: replace(pick, series=f"{short}_{pick.series}")
            for short in DIRECTIONS
            for name, pick in _quantiles(short, quartiles).items()
        }
        found = selected_quantiles(values, by, picks, dict.fromkeys(columns, 3))
        stats = stats.join(found, by, "left")
    else:
        together = rows.repartition(*by) if parts is None else rows.repartition(parts, *by)
        ranked = with_ranks(together, [*by, "direction", "is_first"], ["mbps", "MinRTT"])
        exact = {
            name: ranked_value(pick, f"direction = '{short}' AND is_first")
            for short in DIRECTIONS
            for name, pick in _quantiles(short, quartiles).items()
        }
        stats = ranked.groupBy(*by).agg(*_aliased(plain | exact))
    counts = [f"_{s}_bucket{i}" for s in DIRECTIONS for i in range(len(buckets.EDGES))]
    return stats.where("dl_samples_day > 0 AND ul_samples_day > 0").selectExpr(
        *map(quoted, by),
        *counts,
        *[
            _rounded(c)
            for short in DIRECTIONS
            for c in daily_columns(short)
        ],
    )


def _rounded(column: str) -> str:
    """Means are steadied first; minima, maxima and quantiles are values of the data."""
    if column.endswith("samples_day"):
        return column
    rounding = steady_round if "AVG" in column else plain_round
    return f"{rounding(column, 3)} AS {column}"


def _aliased(texts: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS `{name}`") for name, text in texts.items()]


def histogram(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Eight rows per (date, keys), one per bucket, next to the daily statistics."""

    def bucket(i: int) -> str:
        low, high = buckets.EDGES[i]
        fields = [f"{(low if i else 0.0)!r}D", f"{high!r}D"]
        for short in DIRECTIONS:
            count = f"_{short}_bucket{i}"
            fields += [count, steady_round(f"try_divide({count}, {short}_samples_day)", 3)]
        named = [f"{f} AS {n}" for f, n in zip(fields, BUCKET_COLUMNS, strict=True)]
        return f"struct({', '.join(named)})"

    rows = ", ".join(bucket(i) for i in range(len(buckets.EDGES)))
    stats = [c for short in DIRECTIONS for c in daily_columns(short)]
    return daily.selectExpr(
        "date", *map(quoted, keys), f"inline(array({rows}))", *stats
    )

"""Attributes of map features: census, broadband filings and half-year statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.sources.files import write_lines

# Lengths to which ids are padded, thresholds of the bucket's lower
# edge in Mbps, population groups that get a share, codes dropped on output.
PADDED = {"block": 11, "tract": 11, "county": 5}
AUDIO, VIDEO = 2.5, 10
POPULATIONS = ("white", "black", "asian", "hispanic", "amerindian")
TRACT_PARTS = ("STATEFP10", "COUNTYFP10", "TRACTCE10")


def _number(text: str) -> Column:
    """A number from text; blank counts as 0, and what is no number is left out."""
    return F.when(F.trim(text) == "", F.lit(0.0)).otherwise(F.expr(f"try_cast({text} AS DOUBLE)"))


def filings_by(offers: DataFrame, geography: str) -> DataFrame:
    """Providers, mean advertised speeds and rows per block, tract or county."""
    fips = F.col(f"{geography}_fips")
    width = PADDED[geography]
    padded = F.when(F.length(fips) < width, F.lpad(fips, width, "0")).otherwise(fips)
    return (
        offers.groupBy(padded.alias("geo_id"))
        .agg(
            F.count_distinct("provider_id").alias("provider_count"),
            F.avg(_number("max_ad_down")).alias("mean_max_ad_down"),
            F.avg(_number("max_ad_up")).alias("mean_max_ad_up"),
            F.count(F.lit(1)).alias("source_rows"),
        )
    )


def _median(value: str) -> Column:
    """Median of the few daily values of a half-year; of two middle values, their mean."""
    values = F.array_sort(F.collect_list(value))
    n = F.size(values)
    low = F.get(values, F.floor((n - 1) / 2).cast("int"))
    return (low + F.get(values, F.floor(n / 2).cast("int"))) / 2


SUMMARIES = (
    "median_dl",
    "median_ul",
    "total_dl_samples",
    "total_ul_samples",
    "percent_over_audio_threshold",
    "percent_over_video_threshold",
)


def half_years(statistics: DataFrame) -> DataFrame:
    """One row per geography and half-year: medians of daily medians, samples, shares.

    A day's median is on all rows of its buckets; the first bucket's is used. Days
    are reduced first, so that a half-year has at most 184 values.
    """

    def over(limit: float) -> Column:
        return F.sum(F.when(F.col("bucket_min") > limit, F.col("dl_samples_bucket")).otherwise(0))

    first = F.min(F.struct("bucket_min", "download_MED", "upload_MED"))
    days = statistics.groupBy("fips", "date").agg(
        first.alias("first"),
        F.sum("dl_samples_bucket").alias("dl"),
        F.sum("ul_samples_bucket").alias("ul"),
        over(AUDIO).alias("audio"),
        over(VIDEO).alias("video"),
    )
    day = F.col("date").cast("date")
    half = F.when(F.month(day) <= 6, "jan_jun").otherwise("july_dec")
    days = days.withColumn("period", F.concat_ws("_", F.year(day).cast("string"), half))
    total = F.sum("dl")
    return days.groupBy(F.col("fips").alias("geo_id"), "period").agg(
        _median("first.download_MED").alias("median_dl"),
        _median("first.upload_MED").alias("median_ul"),
        total.alias("total_dl_samples"),
        F.sum("ul").alias("total_ul_samples"),
        F.try_divide(F.sum("audio"), total).alias("percent_over_audio_threshold"),
        F.try_divide(F.sum("video"), total).alias("percent_over_video_threshold"),
    )


def periods_of(statistics: DataFrame) -> list[str]:
    """All half-years from the first to the last day of the statistics; two for each year.

    One scan of the dates, which returns one row.
    """
    day = F.col("date").cast("date")
    first, last = statistics.agg(F.min(day), F.max(day)).first()
    if first is None:
        return []
    halves = [(y, h) for y in range(first.year, last.year + 1) for h in (1, 2)]
    ends = (first.year, 1 + (first.month > 6)), (last.year, 1 + (last.month > 6))
    names = {1: "jan_jun", 2: "july_dec"}
    return [f"{y}_{names[h]}" for y, h in halves if ends[0] <= (y, h) <= ends[1]]


def wide_half_years(summary: DataFrame, periods: Sequence[str]) -> DataFrame:
    """One row per geography with columns `{period}_{summary}`; fails on a period that is not listed."""
    known = F.col("period").isin(list(periods)) if periods else F.lit(False)
    unknown = F.raise_error(F.concat(F.lit("half-year is not listed: "), "period"))
    checked = summary.withColumn("period", F.when(known, F.col("period")).otherwise(unknown))
    values = [F.first(c, ignorenulls=True).alias(c) for c in SUMMARIES]
    return checked.groupBy("geo_id").pivot("period", list(periods)).agg(*values)


def population_shares(demographics: DataFrame) -> DataFrame:
    return demographics.withColumns(
        {f"{p}_pct": F.try_divide(f"{p}_pop", "total_pop") for p in POPULATIONS}
    )


def map_features(
    geography: DataFrame,
    demographics: DataFrame,
    internet: DataFrame,
    filings: DataFrame,
    statistics: DataFrame,
) -> DataFrame:
    """Features with all attributes that are known for them, joined by id.

    `geography` and `internet` are keyed by `fips`, the others by `geo_id`; ids are
    strings and unique on both sides. Features without a match keep NULLs.
    """
    joined = geography
    for table, key in (
        (population_shares(demographics), "geo_id"),
        (internet, "fips"),
        (filings, "geo_id"),
        (statistics, "geo_id"),
    ):
        keyed = table.withColumn(key, F.col(key).cast("string")).withColumnRenamed(key, "fips")
        joined = joined.join(keyed, "fips", "left")
    return joined


def published(features: DataFrame) -> DataFrame:
    """Features without the codes their id is made of."""
    return features.drop(*TRACT_PARTS)


# The texts around the features of a GeoJSON file.
COLLECTION = ('{"type":"FeatureCollection","features":[', "]}")


def feature_lines(features: DataFrame, layer: str) -> DataFrame:
    """(path, line): each feature as GeoJSON, in the file of its state.

    The file has one state's features, so a layer of any size is many files of a bounded size. All columns but `geometry`
    and `rings` are properties; unknown ones are null. A feature without geometry has a null one.
    """
    names = [c for c in features.columns if c not in ("geometry", "rings")]
    properties = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    line = F.concat(
        F.lit('{"type":"Feature","geometry":'), F.coalesce("geometry", F.lit("null")),
        F.lit(',"properties":'), properties, F.lit("}"),
    )
    path = F.concat(F.lit(f"{layer}/"), F.substring("fips", 1, 2), F.lit(".geojson"))
    return features.select(path.alias("path"), "fips", line.alias("line"))


def write_features(features: DataFrame, layer: str, root: str) -> None:
    """One FeatureCollection per state under `root`, written by the tasks in order of the features' ids."""
    placed = feature_lines(features, layer).repartition("path").sortWithinPartitions("path", "fips", "line")
    write_lines(placed.select("path", "line"), root, COLLECTION)

"""Normalised measurement rows and the row filters of each level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.functions.address import parse_ip
from netstats.functions.fingerprint import fingerprint
from netstats.levels import REGION, Level


def between_dates(tests: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """Rows of an inclusive date range; prunes partitions when `column` is one."""
    return tests.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def region_code() -> Column:
    """Country and first subdivision, or country and region where there is none.

    `concat` rather than `concat_ws`: a missing part makes the code missing.
    """
    country = F.col("client.Geo.CountryCode")
    subdivision = F.col("client.Geo.Subdivision1ISOCode")
    return F.when(subdivision != "", F.concat(country, F.lit("-"), subdivision)).otherwise(
        F.concat(country, F.lit("-"), F.col("client.Geo.Region"))
    )


def region_available() -> Column:
    subdivision = F.col("client.Geo.Subdivision1ISOCode")
    region = F.col("client.Geo.Region")
    return (subdivision.isNotNull() | region.isNotNull()) & ((subdivision != "") | (region != ""))


def clean(tests: DataFrame, hashing: str = "md5") -> DataFrame:
    """Flat rows with non-zero throughput, shared by all levels."""
    return tests.where(F.col("a.MeanThroughputMbps") != 0).select(
        "date",
        "direction",
        fingerprint(F.col("id"), hashing).alias("fp"),
        parse_ip(F.col("client.IP")).alias("ip"),
        F.col("client.IP").isNotNull().alias("has_ip_text"),
        F.col("client.Geo.ContinentCode").alias("continent_code"),
        F.col("client.Geo.CountryCode").alias("country_code"),
        region_code().alias("region_code"),
        region_available().alias("region_available"),
        F.col("client.Geo.City").alias("city"),
        F.col("client.Network.ASNumber").alias("asn"),
        F.col("client.Geo.Longitude").alias("lon"),
        F.col("client.Geo.Latitude").alias("lat"),
        F.col("a.MeanThroughputMbps").alias("mbps"),
        F.col("a.MinRTT").alias("MinRTT"),
    )


def area_keys(level: Level, names: Sequence[str]) -> list[str]:
    """The keys of a level that its boundary layer gives, of which it has `names`.

    Below state level the boundary layers carry no code of the state, so it comes from the address annotation.
    """
    given = {"GEOID", *names} - ({"state"} if level.boundary != "states" else set())
    return [k for k in level.keys if k in given] if level.boundary else []


def _known(level: Level, keys: Mapping[str, Column]) -> list[Column]:
    """Conditions on the keys of a level."""
    conditions = []
    for name, column in keys.items():
        if name == "asn" or name in level.may_be_empty:
            conditions.append(column.isNotNull())
        elif name != REGION:
            conditions.append(column != "")
    return conditions


def level_areas(level: Level, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The areas of a lookup that a level counts, with the keys that they give it."""
    named = {k: F.col(k) for k in keys}
    return lookup.where(reduce(Column.__and__, _known(level, named))).select("lon", "lat", *keys)


def level_rows(level: Level, cleaned: DataFrame, areas: Sequence[str] = ()) -> DataFrame:
    """Rows and columns of one level: date, direction, its keys, ip, fp, mbps, MinRTT.

    With `areas`, the column `area` stands for these keys, which `level_areas` has checked.
    """
    named = {REGION: F.col("region_code")}
    if level.boundary != "states":
        named["state"] = F.col("region_code")
    keys = {k: named.get(k, F.col(k)) for k in level.keys if k not in areas}
    conditions = [F.col("has_ip_text") if level.ip_text_only else F.col("ip").isNotNull()]
    if level.has_region:
        conditions.append(F.col("region_available"))
    conditions += _known(level, keys)
    return cleaned.where(reduce(Column.__and__, conditions)).select(
        "date",
        "direction",
        *[column.alias(name) for name, column in keys.items()],
        *(["area"] if areas else []),
        "ip",
        "fp",
        "mbps",
        "MinRTT",
    )

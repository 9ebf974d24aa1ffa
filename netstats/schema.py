"""Input schemas (Spark DDL) and the canonical output columns."""

from __future__ import annotations

GEO = (
    "STRUCT<ContinentCode: STRING, CountryCode: STRING, CountryName: STRING, Region: STRING, "
    "Subdivision1ISOCode: STRING, Subdivision1Name: STRING, Subdivision2ISOCode: STRING, "
    "Subdivision2Name: STRING, City: STRING, PostalCode: STRING, Latitude: DOUBLE, "
    "Longitude: DOUBLE, AccuracyRadiusKm: BIGINT>"
)
NETWORK = "STRUCT<CIDR: STRING, ASNumber: BIGINT, ASName: STRING>"
ANNOTATIONS = f"STRUCT<Geo: {GEO}, Network: {NETWORK}>"

# One row per speed test. Download and upload tables have the same shape;
# `direction` ('dl' or 'ul') tells them apart once they are unioned.
MEASUREMENT = (
    "date DATE, direction STRING, id STRING, "
    f"client STRUCT<IP: STRING, Geo: {GEO}, Network: {NETWORK}>, "
    "a STRUCT<MeanThroughputMbps: DOUBLE, MinRTT: DOUBLE>"
)

_RAW_SIDE = (
    "STRUCT<ClientMetadata: ARRAY<STRUCT<Name: STRING, Value: STRING>>, "
    "ServerMeasurements: ARRAY<STRUCT<TCPInfo: STRUCT<wscale: BIGINT, ElapsedTime: BIGINT, "
    "Retransmits: BIGINT>>>>"
)

# One row per test with the raw client and server details; exactly one of
# raw.Download and raw.Upload is set.
FLEET = (
    "ID STRING, date DATE, server STRUCT<Site: STRING, Machine: STRING>, "
    f"client {ANNOTATIONS}, "
    f"raw STRUCT<ClientIP: STRING, Download: {_RAW_SIDE}, Upload: {_RAW_SIDE}>, "
    "a STRUCT<UUID: STRING, TestTime: TIMESTAMP, CongestionControl: STRING, "
    "MeanThroughputMbps: DOUBLE, MinRTT: DOUBLE, LossRate: DOUBLE>"
)

RINGS = "ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"
STATES = f"geo_id STRING, state STRING, state_name STRING, rings {RINGS}"
COUNTIES = (
    "geo_id STRING, county_name STRING, state_fips_code STRING, county_fips_code STRING, "
    "county_gnis_code STRING, lsad_name STRING, lsad_code STRING, fips_class_code STRING, "
    f"rings {RINGS}"
)
TRACTS = f"geo_id STRING, state_name STRING, tract_name STRING, lsad_name STRING, rings {RINGS}"

SERVER = f"STRUCT<Site: STRING, Machine: STRING, Geo: {GEO}, Network: {NETWORK}>"
TCPINFO = (
    f"UUID STRING, TestTime TIMESTAMP, ServerX {SERVER}, ClientX {ANNOTATIONS}, part_date DATE"
)
ANNOTATION_INDEX = "id STRING, date DATE"
TRACEROUTE = (
    "TestTime TIMESTAMP, part_date DATE, Hop ARRAY<STRUCT<Source: STRUCT<IP: STRING, "
    f"hopannotation1: STRUCT<ID: STRING, Timestamp: TIMESTAMP, Annotations: {ANNOTATIONS}>>>>"
)

FILINGS = (
    "Consumer STRING, Provider_Id STRING, BlockCode STRING, MaxAdDown STRING, MaxAdUp STRING"
)

# Short and long names of the two directions, as they appear in column names.
DIRECTIONS = {"dl": "download", "ul": "upload"}


def daily_columns(short: str) -> list[str]:
    """Columns that hold one value per (date, geography) for a direction."""
    long = DIRECTIONS[short]
    return [
        f"{short}_samples_day",
        f"{short}_LOG_AVG_rnd1",
        f"{short}_LOG_AVG_rnd2",
        f"{short}_minRTT_LOG_AVG_rnd1",
        f"{short}_minRTT_LOG_AVG_rnd2",
        f"{long}_MIN",
        f"{long}_Q25",
        f"{long}_MED",
        f"{long}_AVG",
        f"{long}_Q75",
        f"{long}_MAX",
        f"{long}_minRTT_MED",
    ]


BUCKET_COLUMNS = [
    "bucket_min",
    "bucket_max",
    "dl_samples_bucket",
    "dl_frac_bucket",
    "ul_samples_bucket",
    "ul_frac_bucket",
]


def histogram_columns(keys: list[str], attributes: list[str] = ()) -> list[str]:
    """Canonical column order of a histogram table."""
    return [
        "date",
        *keys,
        *BUCKET_COLUMNS,
        *daily_columns("dl"),
        *daily_columns("ul"),
        *attributes,
        "shard",
    ]

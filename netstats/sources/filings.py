"""Broadband filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstats.schema import FILINGS


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """Filing rows of a CSV with a header; columns are found by name, empty ones are ''."""
    names = [part.split()[0] for part in FILINGS.split(", ")]
    return spark.read.csv(path, header=True).select(*names).fillna("")


def consumer_filings(filings: DataFrame) -> DataFrame:
    """Consumer offers with the ids of their block, tract and county."""
    return filings.where(F.col("Consumer") == "1").select(
        F.col("BlockCode").alias("block_fips"),
        F.substring("BlockCode", 1, 11).alias("tract_fips"),
        F.substring("BlockCode", 1, 5).alias("county_fips"),
        F.col("MaxAdDown").alias("max_ad_down"),
        F.col("MaxAdUp").alias("max_ad_up"),
        F.col("Provider_Id").alias("provider_id"),
    )

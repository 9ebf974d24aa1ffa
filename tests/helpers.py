"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from netstats.schema import MEASUREMENT

DAY = date(2024, 3, 1)

GEO = {
    "ContinentCode": "NA", "CountryCode": "US", "CountryName": None, "Region": "CA",
    "Subdivision1ISOCode": "CA", "Subdivision1Name": None, "Subdivision2ISOCode": None,
    "Subdivision2Name": None, "City": "Here", "PostalCode": None, "Latitude": 0.5,
    "Longitude": 0.5, "AccuracyRadiusKm": None,
}


def speed_test(id, mbps, ip="10.0.0.1", direction="dl", rtt=5.0, day=DAY, asn=1, **geo):
    network = {"CIDR": None, "ASNumber": asn, "ASName": None}
    client = {"IP": ip, "Geo": {**GEO, **geo}, "Network": network}
    return (day, direction, str(id), client, {"MeanThroughputMbps": mbps, "MinRTT": rtt})


def frame_of(spark, rows):
    return spark.createDataFrame(rows, MEASUREMENT)


def both_directions(rows):
    """The given rows and the same as uploads."""
    return rows + [(d, "ul", i + "u", c, a) for d, _, i, c, a in rows]


def fp_of(id):
    import hashlib

    return int(hashlib.md5(id.encode()).hexdigest()[:15], 16)


def as_set(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted(map(tuple, rows.collect()), key=repr)


def random_rows(spark, n, partitions=3):
    """Rows for sampling, with ties, copies, NULLs and one address with half of all."""
    i = F.col("id")
    return spark.range(0, n, 1, partitions).select(
        F.lit(DAY).alias("date"),
        F.when(i % 3 == 0, "ul").otherwise("dl").alias("direction"),
        F.concat(F.lit("k"), (i % 2).cast("string")).alias("key"),
        F.when(i % 7 == 0, None)
        .when(i % 2 == 0, "hot")
        .otherwise(F.concat(F.lit("ip"), (i % 11).cast("string")))
        .alias("ip"),
        F.expr(
            "CASE WHEN id % 17 > 0 THEN CAST(conv(substring(md5(CAST(id % 150 AS STRING)), 1, 15), 16, 10) AS BIGINT) END"
        ).alias("fp"),
        (i % 37 / F.lit(4.0) + 0.5).alias("mbps"),
        F.when(i % 5 > 0, (i % 13).cast("double")).alias("MinRTT"),
    )


def daily_frame(spark):
    rows = [speed_test(i, i + 1.0, ip=f"10.0.0.{i}") for i in range(4)]
    return frame_of(spark, both_directions(rows))

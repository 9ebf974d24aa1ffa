from __future__ import annotations

import ipaddress

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import fp_of
from netstats.functions import buckets
from netstats.functions.address import parse_ip
from netstats.functions.fingerprint import fingerprint, slice_of


def expected(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    if "%" in text:
        return None
    if address.version == 4:
        return str(address)
    return ":".join(f"{int.from_bytes(address.packed[i:i + 2]):04x}" for i in range(0, 16, 2))


def parsed(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return [r[0] for r in frame.select(parse_ip(F.col("t"))).collect()]


def test_addresses(spark):
    texts = [
        "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "::1", "0:0:0:0:0:0:0:1", "::", "1::",
        "2001:DB8::1", "::ffff:1.2.3.4", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9",
        "1:2:3:4:5:6:7::8", "1:::2", "1::2::3", "not-an-ip", "", "a", "12345::", ":1", "1:",
        "64:ff9b::192.0.2.33", "::1.2.3.400", "1.2.3.4:5", "fe80::1%eth0", "1:2:3:4:5:6:1.2.3.4",
    ]
    assert parsed(spark, texts) == [expected(t) for t in texts]
    assert parsed(spark, [None]) == [None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.ip_addresses(), min_size=40, max_size=60),
    st.lists(st.text("0123456789abcdefg:.", max_size=24), min_size=40, max_size=60),
)
def test_any_address(spark, addresses, texts):
    many = [str(a) for a in addresses] + [a.exploded for a in addresses if a.version == 6] + texts
    assert parsed(spark, many) == [expected(t) for t in many]


def test_fingerprint_is_portable_and_ordered_by_slices(spark):
    frame = spark.range(200).select(F.col("id").cast("string").alias("t"))
    rows = frame.select("t", fingerprint(F.col("t")).alias("fp"))
    rows = rows.withColumn("slice", slice_of(F.col("fp"), F.lit(7))).collect()
    assert all(r.fp == fp_of(r.t) for r in rows)
    slices = [r.slice for r in sorted(rows, key=lambda r: r.fp)]
    assert slices == sorted(slices) and min(slices) == 0 and max(slices) == 6


def test_fast_fingerprint_fits_the_slices(spark):
    fp = fingerprint(F.col("id").cast("string"), "xxhash64")
    low, high = spark.range(500).select(F.min(fp), F.max(fp)).first()
    assert 0 <= low and high < 1 << 60
    with pytest.raises(ValueError):
        fingerprint(F.col("id"), "other")


def test_bucket_edges_are_left_closed(spark):
    values = [edge for pair in buckets.EDGES for edge in pair] + [0.1, 6000.0]
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    found = [r[0] for r in frame.select(F.expr(buckets.bucket_of("v"))).collect()]

    def bucket(v):
        return next((i for i, (low, high) in enumerate(buckets.EDGES) if low <= v < high), None)

    assert found == [bucket(v) for v in values]
    assert buckets.EDGES[0][0] == 0.5623413251903491

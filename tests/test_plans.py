"""What Spark makes of the queries."""

from __future__ import annotations

import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import DAY, daily_frame
from pyspark.sql import functions as F

from netstats.levels import LEVELS
from netstats.operators.clean import between_dates
from netstats.plans.histograms import level_histogram, prepare
from netstats.operators.quantiles import Quantile, selected_quantiles
from netstats.plans.refresh import read_shards, replace_range, share_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"^[ :+-]*(?:\*\(\d+\) )?Exchange hashpartitioning", plan_of(df), re.M))


@pytest.fixture(scope="module")
def tests(spark, tmp_path_factory):
    root = f"{tmp_path_factory.mktemp('tests')}/table"
    daily_frame(spark).write.partitionBy("date").parquet(root)
    return spark.read.parquet(root)


def test_a_level_takes_two_shuffles_and_no_join(tests):
    table = level_histogram("cities_asn", prepare(tests, rows_at_most=10))
    assert shuffles(table) == 2
    plan = plan_of(table)
    assert "Join" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_scan_is_pruned(tests):
    rows = between_dates(tests, str(DAY), str(DAY))
    plan = plan_of(level_histogram("global_asn", prepare(rows, rows_at_most=10)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partition = re.search(r"PartitionFilters: \[(.*?)\], Pushed", scan)
    assert partition is None or "date" in partition.group(1)
    assert "PostalCode" not in plan.split("ReadSchema")[-1]
    assert "City" not in plan.split("ReadSchema")[-1]
    assert "isnotnull" in scan.lower()


def test_shared_rows_are_not_shuffled_again(tests):
    prepared = share_rows(prepare(tests, rows_at_most=10))
    prepared.rows.count()
    for name in ("continents", "cities_asn"):
        table = level_histogram(LEVELS[name], prepared)
        plan = plan_of(table)
        below_cache = plan.index("InMemoryTableScan")
        assert len(re.findall("Exchange hashpartitioning", plan[:below_cache])) == 1
    prepared.rows.unpersist()


def test_sketched_level_takes_no_window(tests):
    lean, sketched = (plan_of(level_histogram("cities_asn", prepare(tests, rows_at_most=10), quartiles=q)) for q in ("published", "sketch"))
    # The samples are drawn by windows; no others rank their values.
    assert lean.count("Window [") > sketched.count("Window [") > 0
    assert "_rank_mbps" in lean and "_rank_mbps" not in sketched and "Python" not in sketched


def test_selection_takes_no_window(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) AS x")
    found = selected_quantiles(rows, ["k"], {"half": Quantile("x", 1, 2)}, {"x": 3})
    assert "Window" not in plan_of(found)
    assert found.count() == 3


def test_reading_a_shard_skips_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("netstats.plans.refresh.ROW_GROUP_BYTES", 4096)
    rows = spark.range(20_000).select(F.lit(DAY).alias("date"), (F.col("id") * 7919 % 400).alias("shard"), F.md5(F.col("id").cast("string")).alias("v"))
    replace_range(rows.repartition(4), str(tmp_path / "t"), str(DAY), str(DAY))
    found = read_shards(spark, str(tmp_path / "t"), 17, 17)
    scan = next(x for x in plan_of(found).splitlines() if "FileScan" in x)
    assert "GreaterThanOrEqual(shard,17)" in scan and "LessThanOrEqual(shard,17)" in scan
    assert found.count() == 50
    groups = holding = 0
    for file in Path(tmp_path / "t").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("shard")
        bounds = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        assert all(a.max <= b.min for a, b in zip(bounds, bounds[1:]))
        groups, holding = groups + len(bounds), holding + sum(b.min <= 17 <= b.max for b in bounds)
    assert groups >= 8 and holding <= groups // 4

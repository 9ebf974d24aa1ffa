"""Time the level pipeline next to the plan its SQL spells out.

The literal plan samples each direction with sorted arrays, joins its samples to the
eight buckets, aggregates statistics and buckets apart, and joins the four results.

    python tools/literal.py [SF_DIR]
"""

from __future__ import annotations

import sys
import time
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import bench
from netstats.functions import buckets
from netstats.functions.fingerprint import shard
from netstats.functions.numbers import log_mean, steady_round
from netstats.levels import LEVELS
from netstats.operators.clean import level_rows
from netstats.operators.sampling import FIRST, SECOND
from netstats.plans.histograms import level_histogram, prepare
from netstats.schema import DIRECTIONS, histogram_columns
from workload import tables


def sampled(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    members = F.array_sort(F.collect_list(F.struct("fp", "mbps", "MinRTT")))
    grouped = rows.groupBy("date", *keys, "ip").agg(members.alias("m"))
    return grouped.select(
        "date", *keys,
        F.get("m", F.lit(FIRST) % F.size("m")).alias("r1"),
        F.get("m", F.lit(SECOND) % F.size("m")).alias("r2"),
    ).select("date", *keys, *[
        F.col(f"r{i}.{c}").alias(f"{c}{i}") for i in (1, 2) for c in ("mbps", "MinRTT")
    ])


def stats(samples: DataFrame, keys: tuple[str, ...], short: str) -> DataFrame:
    long = DIRECTIONS[short]

    def disc(column: str, p: float) -> str:
        return f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})"

    texts = {
        f"{short}_LOG_AVG_rnd1": log_mean("mbps1"),
        f"{short}_LOG_AVG_rnd2": log_mean("mbps2"),
        f"{short}_minRTT_LOG_AVG_rnd1": log_mean("MinRTT1"),
        f"{short}_minRTT_LOG_AVG_rnd2": log_mean("MinRTT2"),
        f"{long}_MIN": "min(mbps1)",
        f"{long}_Q25": disc("mbps1", 0.24),
        f"{long}_MED": disc("mbps1", 0.49),
        f"{long}_AVG": "avg(mbps1)",
        f"{long}_Q75": disc("mbps1", 0.74),
        f"{long}_MAX": "max(mbps1)",
        f"{long}_minRTT_MED": disc("MinRTT1", 0.49),
    }
    aggregates = [F.expr(f"{steady_round(t, 3)} AS {n}") for n, t in texts.items()]
    count = F.count(F.lit(1)).alias(f"{short}_samples_day")
    return samples.groupBy("date", *keys).agg(count, *aggregates)


def counts(samples: DataFrame, keys: tuple[str, ...], short: str) -> DataFrame:
    spark = samples.sparkSession
    edges = spark.createDataFrame(buckets.EDGES, "low DOUBLE, bucket_max DOUBLE")
    inside = (F.col("mbps1") >= F.col("low")) & (F.col("mbps1") < F.col("bucket_max"))
    label = F.when(F.col("low") == buckets.EDGES[0][0], 0.0).otherwise(F.col("low"))
    return (
        samples.crossJoin(F.broadcast(edges))
        .groupBy("date", *keys, label.alias("bucket_min"), "bucket_max")
        .agg(
            F.count_if(inside).alias(f"{short}_samples_bucket"),
            F.round(F.count_if(inside) / F.count(F.lit(1)), 3).alias(f"{short}_frac_bucket"),
        )
    )


def literal(name: str, cleaned: DataFrame) -> DataFrame:
    level = LEVELS[name]
    rows, by = level_rows(level, cleaned), ["date", *level.keys]
    parts = {s: sampled(rows.where(F.col("direction") == s), level.keys) for s in DIRECTIONS}
    bucketed = reduce(
        lambda a, b: a.join(b, [*by, "bucket_min", "bucket_max"]),
        [counts(parts[s], level.keys, s) for s in DIRECTIONS],
    )
    table = reduce(
        lambda a, b: a.join(b, by), [stats(parts[s], level.keys, s) for s in DIRECTIONS], bucketed
    )
    column, shards = level.shard_by
    return table.withColumn("shard", shard(F.col(column), shards)).select(
        *histogram_columns(list(level.keys))
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = bench.session(8)
    prepared = prepare(tables.shipments(spark, sf_dir))
    cleaned = prepared.rows.persist()
    print(f"{cleaned.count()} tests, cleaned and kept in memory")
    for name in ("continents", "countries_asn", "global_asn"):
        plans = {
            "level pipeline": lambda n=name: level_histogram(n, prepared),
            "literal plan": lambda n=name: literal(n, cleaned),
        }
        results = {}
        for label, plan in plans.items():
            for _ in range(2):
                started = time.perf_counter()
                plan().write.format("noop").mode("overwrite").save()
                results[label] = time.perf_counter() - started
        same = plans["level pipeline"]().exceptAll(plans["literal plan"]()).count()
        print(name, {k: round(v, 2) for k, v in results.items()}, f"{same} rows differ", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

from __future__ import annotations

import pytest
from helpers import DAY, as_set, both_directions, fp_of, random_rows, speed_test, frame_of
from pyspark.sql import functions as F

from netstats.levels import LEVELS, REGION
from netstats.limits import Limits
from netstats.operators import sketches
from netstats.operators.quantiles import Quantile, selected_quantiles
from netstats.operators.sampling import FIRST, SECOND, draw, pair
from netstats.operators.skew import hot_groups
from netstats.operators.summary import daily_statistics, histogram
from netstats.plans.histograms import draws, level_histogram, prepare
from netstats.schema import histogram_columns
from netstats.sources.geography import boundaries_from_wkt

TINY = Limits(tests_per_group=10, samples_per_group=5)


def continents(spark, rows, **options):
    return level_histogram("continents", prepare(frame_of(spark, rows)), **options)


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_draw_positions(spark, n):
    rows = [speed_test(i, float(i + 1)) for i in range(n)]
    prepared = prepare(frame_of(spark, rows))
    from netstats.operators.clean import level_rows

    drawn = draw(level_rows(LEVELS["continents"], prepared.rows), ["continent_code"])
    row = pair(drawn, ["continent_code"]).first()
    ordered = sorted(range(n), key=lambda i: fp_of(str(i)))
    assert row.tests == n
    assert row.mbps_rnd1 == ordered[FIRST % n] + 1
    assert row.mbps_rnd2 == ordered[SECOND % n] + 1


def test_draws_do_not_depend_on_partitioning(spark):
    one = draw(random_rows(spark, 600, 1), ["key"])
    many = draw(random_rows(spark, 600, 7).repartition(5, "mbps"), ["key"])
    assert as_set(one) == as_set(many)


def test_hot_addresses_give_the_same_draws(spark):
    rows = random_rows(spark, 1500)
    limits = Limits(tests_per_group=10)
    hot = hot_groups(rows, ["date", "direction", "ip"], limits.tests_per_group)
    assert hot is not None and hot.where("ip IS NULL").count() == 2
    spread = draw(rows, ["key"], hot, limits)
    assert as_set(pair(spread, ["key"])) == as_set(pair(draw(rows, ["key"]), ["key"]))


def test_only_hot_addresses_are_sliced(spark):
    # A hot address whose tests have no id, or share one, next to ordinary ones.
    i = F.col("id")
    rows = random_rows(spark, 900).unionByName(
        spark.range(400).select(
            F.lit(DAY).alias("date"), F.lit("dl").alias("direction"), F.lit("k0").alias("key"), F.lit("hot").alias("ip"),
            F.when(i % 4 == 0, 77).cast("bigint").alias("fp"), (i % 97 * 1.5 - 3).alias("mbps"), F.when(i % 3 > 0, i * 1.0).alias("MinRTT"),
        )
    )
    limits = Limits(tests_per_group=100)
    hot = hot_groups(rows, ["date", "direction", "ip"], limits.tests_per_group)
    assert 0 < hot.count() < rows.select("date", "direction", "ip").distinct().count()
    assert as_set(pair(draw(rows, ["key"], hot, limits), ["key"])) == as_set(pair(draw(rows, ["key"]), ["key"]))


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0], [0.001, 4_000_000.0, 3.0], [-2.5, None, 7.125, 0.0], [None]])
def test_selected_quantiles(spark, values, monkeypatch):
    picks = {f"q{p}": Quantile("x", p, 100) for p in (0, 1, 24, 50, 74, 100)}
    rows = spark.createDataFrame([("a", v) for v in values] + [(None, v * 2.0) for v in range(500)], "k string, x double")
    found = {r.k: r for r in selected_quantiles(rows, ["k"], picks, {"x": 3}).collect()}
    given = sorted(v for v in values if v is not None)
    for name, q in picks.items():
        assert found[None][name] == 2.0 * (max(-(-500 * q.part // 100), 1) - 1)
        if given:
            assert found["a"][name] == given[max(-(-len(given) * q.part // 100), 1) - 1]
    assert given or "a" not in found
    if len(given) > 2:
        monkeypatch.setattr("netstats.operators.quantiles.BINS", 4)
        with pytest.raises(Exception, match="differ by more than"):
            selected_quantiles(rows, ["k"], picks, {"x": 3}).collect()


def test_sketches_merge_over_days(spark):
    rows = spark.range(20_000).select(
        (F.lit(DAY) + (F.col("id") % 5).cast("int")).alias("date"), F.lit("k").alias("key"), F.lit("dl").alias("direction"),
        (F.col("id") % 2 == 0).alias("is_first"), F.col("id").cast("double").alias("mbps"), F.lit(None).cast("double").alias("MinRTT"),
    )
    daily = sketches.daily_sketches(rows, ["key"])
    assert daily.count() == 5
    row = sketches.merged(daily, ["key"]).select(
        sketches.samples("dl_mbps").alias("n"), sketches.quantile("dl_mbps", 1, 2).alias("half"),
        sketches.quantile("dl_MinRTT", 1, 2).alias("none"), sketches.samples("ul_mbps").alias("no"),
    ).first()
    assert row.n == 10_000 and abs(row.half / 20_000 - 0.5) <= sketches.RANK_ERROR and row.none is None and row.no == 0


def test_few_hot_addresses_are_found(spark):
    rows = random_rows(spark, 300)
    assert hot_groups(rows, ["date", "direction", "ip"], 300) is None


def test_spread_statistics_are_the_same(spark):
    drawn = draw(random_rows(spark, 3000).withColumn("ip", F.col("fp").cast("string")), ["key"])
    lean = daily_statistics(drawn, ["key"])
    spread = daily_statistics(drawn, ["key"], spread=True)
    assert lean.count() == 2
    assert as_set(lean.select(sorted(lean.columns))) == as_set(spread.select(sorted(lean.columns)))


def test_levels_agree_under_tiny_limits(spark):
    rows = [
        speed_test(i, i % 40 + 0.25, ip=f"10.0.0.{i % 9}", rtt=float(i % 6), asn=i % 3, City=f"c{i % 2}")
        for i in range(400)
    ]
    tests = frame_of(spark, both_directions(rows))
    for name in ("continents", "cities_asn", "global_asn"):
        lean = level_histogram(name, prepare(tests))
        hot = prepare(tests, limits=TINY)
        assert hot.hot_addresses is not None and hot.spread_quantiles
        assert as_set(level_histogram(name, hot, limits=TINY)) == as_set(lean)


def test_row_bound_skips_the_profile(spark):
    tests = frame_of(spark, [speed_test(i, 1.0) for i in range(20)])
    assert prepare(tests, rows_at_most=20).hot_addresses is None
    found = prepare(tests, rows_at_most=20, limits=Limits(tests_per_group=10))
    assert found.hot_addresses is not None


def test_quartiles(spark):
    rows = both_directions([speed_test(i, float(i), ip=f"10.0.1.{i}") for i in range(1, 101)])
    row = continents(spark, rows).first()
    assert (row.download_Q25, row.download_MED, row.download_Q75) == (24, 49, 74)
    row = continents(spark, rows, quartiles="documented").first()
    assert (row.upload_Q25, row.upload_MED, row.upload_Q75) == (25, 50, 75)


def test_values_outside_all_buckets(spark):
    values = [0.1, 1.0, 6000.0]
    rows = both_directions([speed_test(i, v, ip=f"10.0.1.{i}") for i, v in enumerate(values)])
    found = continents(spark, rows).orderBy("bucket_max").collect()
    assert len(found) == 8
    assert [r.dl_samples_bucket for r in found] == [1, 0, 0, 0, 0, 0, 0, 0]
    assert found[0].bucket_min == 0.0 and found[0].dl_frac_bucket == 0.333
    assert {r.dl_samples_day for r in found} == {3}


def test_one_direction_is_not_enough(spark):
    assert continents(spark, [speed_test(1, 1.0)]).count() == 0


def test_zero_and_missing_throughput(spark):
    rows = both_directions([speed_test(1, 0.0), speed_test(2, None), speed_test(3, 2.0, ip="10.0.0.2")])
    assert {r.dl_samples_day for r in continents(spark, rows).collect()} == {1}


def test_round_trip_times_of_zero_or_less(spark):
    rows = [
        speed_test(1, 1.0, ip="10.0.0.1", rtt=0.0),
        speed_test(2, 1.0, ip="10.0.0.2", rtt=-1.0),
        speed_test(3, 1.0, ip="10.0.0.3", rtt=8.0),
    ]
    row = continents(spark, both_directions(rows)).first()
    assert row.dl_samples_day == 3 and row.dl_minRTT_LOG_AVG_rnd1 == 8.0


def test_missing_round_trip_times(spark):
    rows = [speed_test(i, 1.0, ip=f"10.0.0.{i}", rtt=None) for i in range(3)]
    row = continents(spark, both_directions(rows)).first()
    assert row.download_minRTT_MED is None and row.dl_minRTT_LOG_AVG_rnd1 is None


def test_address_text_that_does_not_parse(spark):
    rows = both_directions([speed_test(i, 1.0 + i, ip="not-an-ip") for i in range(2)])
    prepared = prepare(frame_of(spark, rows))
    assert level_histogram("continents", prepared).count() == 0
    region = level_histogram("regions", prepared).first()
    assert region.dl_samples_day == 1  # both rows share the group without an address


def test_spellings_of_one_address(spark):
    rows = [speed_test(1, 1.0, ip="::1"), speed_test(2, 2.0, ip="0:0:0:0:0:0:0:1")]
    assert continents(spark, both_directions(rows)).first().dl_samples_day == 1


@pytest.mark.parametrize(
    ("subdivision", "region", "code"),
    [
        ("CA", None, "US-CA"), ("", "TX", "US-TX"), (None, "TX", "US-TX"),
        (None, None, None), ("", "", None), ("", None, None), (None, "", None),
    ],
)
def test_region_codes(spark, subdivision, region, code):
    rows = both_directions([speed_test(1, 1.0, Subdivision1ISOCode=subdivision, Region=region)])
    found = level_histogram("regions", prepare(frame_of(spark, rows)))
    assert {r.ISO3166_2region1 for r in found.collect()} == ({code} if code else set())


@pytest.mark.parametrize("name", LEVELS)
def test_keys_must_be_present(spark, name):
    level = LEVELS[name]
    columns = {"continent_code": "ContinentCode", "country_code": "CountryCode", "city": "City"}
    good = speed_test(1, 1.0)
    rows = [good]
    for key in level.keys:
        for bad in ("", None):
            if key in columns:
                rows.append(speed_test(2, 1.0, **{columns[key]: bad}))
    if "asn" in level.keys:
        rows.append(speed_test(3, 1.0, asn=None))
    layers = {}
    if level.boundary:
        # One good polygon around all tests, and for each name the layer supplies one that lacks it.
        named = {k: "n" for k in (*level.keys, *level.attributes) if k not in columns and k not in ("GEOID", "asn", REGION)}
        named = {k: v for k, v in named.items() if k != "state" or level.name.startswith("states")}
        flawed = [k for k in named if k not in level.attributes]
        shapes = [{"geo_id": "01", **named}]
        for key in flawed:
            shapes += [{"geo_id": f"{key}-null", **named, key: None}]
            shapes += [{"geo_id": f"{key}-empty", **named, key: ""}] if key not in level.may_be_empty else []
        schema = ", ".join(f"{k} STRING" for k in shapes[0])
        layer = spark.createDataFrame([tuple(x.values()) for x in shapes], schema)
        box = F.lit("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")
        layers = {level.boundary: boundaries_from_wkt(layer.withColumn("wkt", box), "wkt")}
    found = level_histogram(name, prepare(frame_of(spark, both_directions(rows))), layers)
    assert found.columns == histogram_columns(list(level.keys), list(level.attributes))
    assert {r.dl_samples_day for r in found.collect()} == {1} and found.count() == 8


def test_invariants(spark):
    drawn = draw(random_rows(spark, 900), ["key"])
    rows = histogram(daily_statistics(drawn, ["key"]), ["key"])
    per_day = rows.groupBy("date", "key").agg(
        F.count("*").alias("n"), F.sum("dl_samples_bucket").alias("s"), F.max("dl_samples_day").alias("d")
    )
    for row in per_day.collect():
        assert row.n == 8 and row.s <= row.d


def test_fifteen_levels():
    assert len(LEVELS) == 15
    assert LEVELS["cities_asn"].path == (
        "v0/{continent_code}/{country_code}/{ISO3166_2region1}/{city}/asn/{asn}/{year}/"
        "histogram_daily_stats.json"
    )
    assert LEVELS["states_asn"].shard_by == ("GEOID", 4000)


def test_tasks_grow_with_the_rows(spark):
    """A known number of rows gives as many tasks as it asks for, for the draws and for the statistics."""
    tests = frame_of(spark, both_directions([speed_test(i, i + 1.0, ip=f"10.0.0.{i}") for i in range(4)]))
    prepared = prepare(tests, rows_at_most=100, limits=Limits(rows_per_task=10))
    assert prepared.parts == 10 and prepare(tests).parts is None
    drawn = draws("continents", prepared)
    assert "continent_code" in drawn.columns and drawn.rdd.getNumPartitions() == 10
    dealt = level_histogram("continents", prepared)
    assert dealt.rdd.getNumPartitions() == 10
    assert as_set(dealt) == as_set(level_histogram("continents", prepare(tests)))

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from netstats.plans import mapdata
from netstats.sources.filings import consumer_filings, read_filings
from netstats.sources.geography import read_census
from netstats.sources.statistics import ROW


def test_filings(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "LogRecNo,Provider_Id,BlockCode,MaxAdDown,MaxAdUp,Consumer\n"
        "1,p1,010010201001000,10,1,1\n"
        "2,p1,010010201001000,,2,1\n"
        "3,p2,010010201001000,30,x,1\n"
        "4,p3,010010201002000,50,5,1\n"
        "5,p4,010010201001000,99,9,0\n"
    )
    offers = consumer_filings(read_filings(spark, str(tmp_path / "f.csv")))
    block = {r.geo_id: r for r in mapdata.filings_by(offers, "block").collect()}
    row = block["010010201001000"]
    assert (row.provider_count, row.source_rows) == (2, 3)
    assert row.mean_max_ad_down == 40 / 3 and row.mean_max_ad_up == 1.5
    (tract,) = mapdata.filings_by(offers, "tract").collect()
    assert tract.geo_id == "01001020100" and tract.provider_count == 3
    (county,) = mapdata.filings_by(offers, "county").collect()
    assert county.geo_id == "01001" and county.source_rows == 4


def test_short_ids_are_padded_and_long_ones_kept(spark):
    offers = spark.sql(
        "SELECT '123' AS county_fips, '123456789012' AS tract_fips, 'p' AS provider_id, "
        "'1' AS max_ad_down, '1' AS max_ad_up"
    )
    assert mapdata.filings_by(offers, "county").first().geo_id == "00123"
    assert mapdata.filings_by(offers, "tract").first().geo_id == "123456789012"


def test_half_years(spark):
    rows = [
        ("2020-06-29", 0.0, 4, 10.0, 1, 1.0), ("2020-06-29", 17.8, 6, 10.0, 1, 1.0),
        ("2020-06-30", 5.6, 10, 20.0, 1, 4.0), ("2020-07-01", 0.0, 5, 7.0, 2, None),
    ]
    stats = spark.createDataFrame(rows, ROW).withColumn("fips", F.lit("06001"))
    found = {r.period: r for r in mapdata.half_years(stats).collect()}
    first, second = found["2020_jan_jun"], found["2020_july_dec"]
    assert first.median_dl == 15.0 and first.median_ul == 2.5
    assert first.total_dl_samples == 20 and first.total_ul_samples == 3
    assert first.percent_over_audio_threshold == 0.8 and first.percent_over_video_threshold == 0.3
    assert second.median_dl == 7.0 and second.median_ul is None
    assert second.percent_over_audio_threshold == 0.0
    wide = mapdata.wide_half_years(mapdata.half_years(stats), mapdata.periods_of(stats)).first()
    assert wide["2020_july_dec_total_dl_samples"] == 5 and "2021_jan_jun_median_dl" not in wide
    more = ["2020_jan_jun", "2020_july_dec", "2021_jan_jun"]
    wide = mapdata.wide_half_years(mapdata.half_years(stats), more).first()
    assert wide["2021_jan_jun_median_dl"] is None
    with pytest.raises(Exception, match="half-year is not listed: 2020_july_dec"):
        mapdata.wide_half_years(mapdata.half_years(stats), more[:1]).collect()
    assert mapdata.periods_of(stats.limit(0)) == []


def test_features(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "geo_id,total_pop,white_pop,black_pop,asian_pop,hispanic_pop,amerindian_pop\n"
        "01001,200,100,50,0,x,10\n02001,0,0,0,0,0,0\n"
    )
    numbers = ["total_pop", *[f"{p}_pop" for p in mapdata.POPULATIONS]]
    people = read_census(spark, str(tmp_path / "d.csv"), "geo_id", numbers)
    features = spark.sql(
        "SELECT fips, left(fips, 2) AS STATEFP10, '001' AS COUNTYFP10, '' AS TRACTCE10 "
        "FROM VALUES ('01001'), ('02001'), ('03001') AS t(fips)"
    )
    internet = spark.sql("SELECT '01001' AS fips, 5 AS broadband")
    filings = spark.sql("SELECT '02001' AS geo_id, 3L AS provider_count")
    stats = spark.sql("SELECT '03001' AS geo_id, 9.5D AS `2020_jan_jun_median_dl`")
    joined = mapdata.map_features(features, people, internet, filings, stats)
    rows = {r.fips: r for r in mapdata.published(joined).collect()}
    assert rows["01001"].white_pct == 0.5 and rows["01001"].hispanic_pct is None
    assert rows["01001"].broadband == 5 and rows["02001"].white_pct is None
    assert rows["02001"].provider_count == 3 and rows["03001"]["2020_jan_jun_median_dl"] == 9.5
    assert "STATEFP10" not in rows["01001"] and "geo_id" not in rows["01001"]

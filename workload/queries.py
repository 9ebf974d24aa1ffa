"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstats.functions.address import parse_ip
from netstats.levels import LEVELS
from netstats.limits import Limits
from netstats.operators import sketches
from netstats.operators.clean import level_rows
from netstats.operators.outlines import dissolve_layer, dissolve_rings
from netstats.operators.sampling import pair
from netstats.operators.skew import join_null_safe
from netstats.operators.spatial import dissolve, locate_points
from netstats.operators.sphere import locate_on_sphere
from netstats.operators.summary import daily_statistics
from netstats.plans import annotation, export, fleet, jobs, mapdata
from netstats.plans.histograms import Prepared, draws, level_histogram, prepare
from netstats.plans.refresh import read_shards, refresh
from netstats.schema import BUCKET_COLUMNS, daily_columns
from netstats.sources.filings import consumer_filings, read_filings
from netstats.sources.geography import boundaries_from_wkt, read_census, read_geojson, tract_ids
from netstats.sources.measurements import read_tests
from netstats.sources.statistics import read_statistics
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return keep


def _rows(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Rows of a table, from its footers."""
    return tables.read(spark, sf_dir, table).count()


def _prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """Cleaned measurements. There is one per event, which bounds their number."""
    tests = tables.measurements(spark, sf_dir)
    return prepare(tests, rows_at_most=_rows(spark, sf_dir, "events"))


def _prepared_shipments(spark: SparkSession, sf_dir: str) -> Prepared:
    tests = tables.shipments(spark, sf_dir)
    return prepare(tests, rows_at_most=_rows(spark, sf_dir, "lineitem"))


def _level(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    layer = LEVELS[name].boundary
    boundaries = {layer: tables.BOUNDARIES[layer](spark, sf_dir)} if layer else None
    return level_histogram(name, _prepared(spark, sf_dir), boundaries)


def _level_query(name: str) -> Query:
    return lambda spark, sf_dir: _level(spark, sf_dir, name)


for _name in LEVELS:
    QUERIES[f"level_{_name}"] = _level_query(_name)


@register("level_continents_documented_quartiles")
def _documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_histogram("continents", _prepared(spark, sf_dir), quartiles="documented")


def _shipments_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return level_histogram(name, _prepared_shipments(spark, sf_dir))

    return query


for _name in ("continents", "countries_asn", "global_asn"):
    QUERIES[f"shipments_{_name}"] = _shipments_query(_name)


# Limits under which nearly every group of the given tables counts as too large for
# the lean plans, so that the plans for hot keys run over whole tables.
TIGHT = Limits(tests_per_group=3, samples_per_group=2)


def _tight_level_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = prepare(tables.measurements(spark, sf_dir), limits=TIGHT)
        layer = LEVELS[name].boundary
        boundaries = {layer: tables.BOUNDARIES[layer](spark, sf_dir)} if layer else None
        return level_histogram(name, prepared, boundaries, limits=TIGHT)

    return query


for _name in ("continents", "countries_asn", "regions", "states", "counties"):
    QUERIES[f"level_{_name}_spread"] = _tight_level_query(_name)


@register("level_states_from_text")
def _level_states_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state level with polygons given as text."""
    layer = boundaries_from_wkt(tables.state_texts(spark, sf_dir), "state_geom")
    return level_histogram("states", _prepared(spark, sf_dir), {"states": layer})


@register("clean_rows")
def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_rows(LEVELS["cities_asn"], _prepared(spark, sf_dir).rows)


@register("parse_addresses")
def _parse_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = tables.addresses(spark, sf_dir).withColumn("ip", parse_ip(F.col("text")))
    return parsed.groupBy("ip").agg(
        F.count(F.lit(1)).alias("tests"), F.count_distinct("text").alias("spellings")
    )


@register("ip_sample")
def _ip_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = LEVELS["countries"].keys
    return pair(draws("countries", _prepared(spark, sf_dir)), keys)


@register("log_histogram")
def _log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = LEVELS["countries_asn"].keys
    return _level(spark, sf_dir, "countries_asn").select("date", *keys, *BUCKET_COLUMNS)


@register("daily_stats")
def _daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = LEVELS["regions"].keys
    daily = daily_statistics(draws("regions", _prepared(spark, sf_dir)), keys)
    return daily.select("date", *keys, *daily_columns("dl"), *daily_columns("ul"))


@register("shard_sizes")
def _shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.shard_sizes(_level(spark, sf_dir, "cities"))


@register("geographies")
def _geographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.geographies(_level(spark, sf_dir, "regions"), "regions")


@register("export_json")
def _export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.file_contents(_level(spark, sf_dir, "countries"), "countries")


def _scratch(spark: SparkSession) -> str:
    """A new folder in the place all executors share: a folder of this machine only where it runs alone."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp()
    return f"{shared.rstrip('/')}/netstats-{uuid.uuid4().hex}"


@register("exported_files")
def _exported_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written by the export, read back."""
    root = _scratch(spark)
    export.export(_level(spark, sf_dir, "counties"), "counties", root)
    files = spark.read.text(f"{root}/v0/NA/US/counties/*/*/*.json", wholetext=True)
    path = F.regexp_extract(F.input_file_name(), "/(v0/.*)$", 1)
    return files.select(path.alias("path"), F.col("value").alias("content"))


@register("refreshed_table")
def _refreshed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table filled for a month, refreshed for two of its weeks, and read back."""
    tests, root = tables.measurements(spark, sf_dir), _scratch(spark)
    for start, end in (("2024-01-01", "2024-01-31"), ("2024-01-08", "2024-01-21")):
        failed = refresh(tests, start, end, root, ["countries"])
        if failed:
            raise RuntimeError("; ".join(failed))
    return spark.read.parquet(f"{root}/countries")


@register("exported_shard")
def _exported_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a table's largest shard, read from its folder."""
    root = _scratch(spark)
    refresh(tables.measurements(spark, sf_dir), "2024-01-01", "2024-01-31", root, ["regions"])
    sizes = export.shard_sizes(spark.read.parquet(f"{root}/regions"))
    largest = sizes.orderBy(F.desc("rows"), "shard").first()["shard"]
    return export.file_contents(read_shards(spark, f"{root}/regions", largest, largest).drop("year"), "regions")


@register("level_countries_from_files")
def _level_countries_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country level for two weeks of downloads and uploads kept in files by day."""
    root, tests = _scratch(spark), tables.measurements(spark, sf_dir)
    for direction, name in (("dl", "downloads"), ("ul", "uploads")):
        tests.where(F.col("direction") == direction).drop("direction").write.partitionBy("date").parquet(f"{root}/{name}")
    found = read_tests(spark, f"{root}/downloads", f"{root}/uploads", "2024-01-08", "2024-01-21")
    return level_histogram("countries", prepare(found))


@register("level_continents_sketch")
def _level_continents_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continent level with quantiles from sketches, which are exact for days of this size."""
    return level_histogram("continents", _prepared(spark, sf_dir), quartiles="sketch")


@register("monthly_quantiles")
def _monthly_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of days merged by month: samples, and whether all quartiles' ranks are within the bound."""
    drawn, month = draws("continents", _prepared_shipments(spark, sf_dir)), F.trunc("date", "month").alias("month")
    by = ["month", "continent_code", "direction"]
    monthly = sketches.merged(sketches.daily_sketches(drawn, ["continent_code"]).withColumn("month", month), by[:2])
    names = F.array(*[
        F.struct(
            F.lit(short).alias("direction"), sketches.samples(f"{short}_mbps").alias("samples"), F.lit(p / 100).alias("p"),
            sketches.quantile(f"{short}_mbps", p, 100).alias("q"),
        )
        for short in ("dl", "ul") for p in (24, 49, 74)
    ])
    found = monthly.select("month", "continent_code", F.inline(names)).where("samples > 0")
    values = drawn.where("is_first").select(month, "continent_code", "direction", "mbps")
    ranks = values.join(found, by).groupBy(*by, "samples", "p").agg(
        F.count_if(F.col("mbps") < F.col("q")).alias("below"), F.count_if(F.col("mbps") <= F.col("q")).alias("upto")
    )
    error = F.lit(sketches.RANK_ERROR) * F.col("samples") + 1
    wanted = F.col("p") * F.col("samples")
    return ranks.groupBy(*by, "samples").agg(
        F.bool_and((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("within_bound")
    )


@register("pip_join")
def _pip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = tables.points(spark, sf_dir)
    found = locate_points(points, tables.diamonds(spark, sf_dir))
    return join_null_safe(points, found, ["lon", "lat"]).select("c_custkey", "geo_id")


@register("pip_sphere")
def _pip_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = tables.points(spark, sf_dir)
    found = locate_on_sphere(points, tables.globe(spark, sf_dir))
    return join_null_safe(points, found, ["lon", "lat"]).select("c_custkey", "geo_id")


@register("dissolve_edges")
def _dissolve_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dissolve(tables.blocks(spark, sf_dir), "tract", ("state",))


@register("dissolved_rings")
def _dissolved_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings around tracts whose blocks have gaps."""
    rings = dissolve_rings(tables.blocks_with_gaps(spark, sf_dir), "tract")
    start = F.col("ring")[0]
    return rings.select(
        "tract", "hole", "area", (F.size("ring") - 1).alias("corners"), start["x"].alias("x"), start["y"].alias("y")
    )


@register("points_in_dissolved")
def _points_in_dissolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracts found for points in dissolved polygons: the middle of every block, gaps included."""
    layer = dissolve_layer(tables.blocks_with_gaps(spark, sf_dir), "tract").withColumnRenamed("tract", "geo_id")
    key = F.col("p_partkey")
    points = tables.read(spark, sf_dir, "part").select(
        (key % 40 + 0.5).alias("lon"), (F.floor(key / 40) + 0.5).alias("lat")
    )
    return locate_points(points, layer)


_CONNECTION_DAYS = ("2018-01-01", "2020-03-10")
_HOP_DAYS = (annotation.HOP_FIRST, annotation.HOP_LAST)


def _missing_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.missing_connections(
        tables.connections(spark, sf_dir), tables.connection_index(spark, sf_dir), *_CONNECTION_DAYS
    )


def _missing_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.missing_hops(
        tables.traces(spark, sf_dir), tables.hop_index(spark, sf_dir), *_HOP_DAYS
    )


@register("anti_join_connections")
def _anti_join_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missing_connections(spark, sf_dir).select(
        "UUID",
        F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss").alias("first_time"),
        F.col("Server.Site").alias("site"),
        F.col("Server.Network.ASNumber").alias("server_asn"),
        F.col("Client.Geo.CountryCode").alias("client_country"),
        "year_month_day",
    )


@register("anti_join_hops")
def _anti_join_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missing_hops(spark, sf_dir).select(
        "ID",
        F.col("Timestamp").alias("first_time"),
        F.col("Annotations.Geo.CountryCode").alias("country"),
        "Date",
        "FilenameTimestamp",
        "Hostname",
        "IP",
    ).withColumnsRenamed({"Date": "hop_date"})


@register("connection_files")
def _connection_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.connection_files(_missing_connections(spark, sf_dir))


@register("hop_files")
def _hop_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.hop_files(_missing_hops(spark, sf_dir))


@register("backfill_days_connections")
def _backfill_days_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = tables.connections(spark, sf_dir)
    return annotation.days_to_backfill(tests, before=annotation.TCPINFO_BEFORE)


@register("backfill_days_hops")
def _backfill_days_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.days_to_backfill(tables.traces(spark, sf_dir), *_HOP_DAYS)


_FLEET_DAYS = ("2024-01-03", "2024-01-28")


@register("canary_numbered")
def _canary_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fleet.numbered(
        fleet.normalise(tables.fleet(spark, sf_dir)),
        rows_at_most=_rows(spark, sf_dir, "events"),
    )
    return rows.select(
        "ID",
        "endpointHash",
        "NDTVersion",
        "elapsedTime",
        F.col("client.isMonitoring").alias("isMonitoring"),
        F.col("client.WScale").alias("WScale"),
        F.col("server.Metro").alias("Metro"),
        *[f"{g}{what}" for g in fleet.GROUPS for what in ("Sample", "Count")],
    )


@register("canary_numbered_spread")
def _canary_numbered_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fleet.numbered(fleet.normalise(tables.fleet(spark, sf_dir)), TIGHT)
    return rows.select("ID", *[f"{g}{what}" for g in fleet.GROUPS for what in ("Sample", "Count")])


@register("canary_rate")
def _canary_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fleet.panel(fleet.normalise(tables.fleet(spark, sf_dir)), *_FLEET_DAYS)
    return fleet.rated(rows).select("ID", "metroFrequency")


@register("canary_stats")
def _canary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_health(
        tables.fleet(spark, sf_dir),
        *_FLEET_DAYS,
        compute_date=F.lit("2024-02-01").cast("date"),
        rows_at_most=_rows(spark, sf_dir, "events"),
    )


@register("canary_stats_spread")
def _canary_stats_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.lit("2024-02-01").cast("date")
    return fleet.fleet_health(tables.fleet(spark, sf_dir), *_FLEET_DAYS, date, limits=TIGHT)


@register("fleet_clients")
def _fleet_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different clients by metro, merged from sketches by machine and day, and whether all counts are within the bound."""
    rows = fleet.panel(fleet.normalise(tables.fleet(spark, sf_dir)), *_FLEET_DAYS)
    seen = rows.select("date", "server.Metro", "server.Site", "server.Machine", "endpointHash")
    daily = sketches.daily_counters(seen, ["date", "Metro", "Site", "Machine"], "endpointHash")
    about = sketches.merged_counters(daily, ["Metro"], "endpointHash")
    exact = seen.groupBy("Metro").agg(F.count_distinct("endpointHash").alias("clients"))
    off = F.abs(sketches.counted("endpointHash") - F.col("clients"))
    return join_null_safe(exact, about, ["Metro"]).select(
        "Metro", "clients", (off <= sketches.COUNT_ERROR * F.col("clients")).alias("within_bound")
    )


def _filings_query(geography: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        offers = consumer_filings(tables.filings(spark, sf_dir))
        return mapdata.filings_by(offers, geography)

    return query


for _name in ("block", "tract", "county"):
    QUERIES[f"filings_by_{_name}"] = _filings_query(_name)


def _steady(frame: DataFrame) -> DataFrame:
    """Medians of two middle values, and shares, without their last bits."""
    noisy = [c for c in frame.columns if "median" in c or "percent" in c or c.endswith("_pct")]
    return frame.withColumns({c: F.round(c, 6) for c in noisy})


@register("halfyear_summary")
def _halfyear_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(mapdata.half_years(tables.statistics(spark, sf_dir, 5)))


@register("halfyear_from_levels")
def _halfyear_from_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = level_histogram("continents", _prepared_shipments(spark, sf_dir))
    rows = table.withColumn("fips", F.col("continent_code"))
    return _steady(mapdata.half_years(rows))


@register("halfyear_wide")
def _halfyear_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = tables.statistics(spark, sf_dir, 5)
    periods = mapdata.periods_of(statistics)
    return _steady(mapdata.wide_half_years(mapdata.half_years(statistics), periods))


@register("map_join")
def _map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = consumer_filings(tables.filings(spark, sf_dir))
    statistics = tables.statistics(spark, sf_dir, 11)
    features = mapdata.map_features(
        tract_ids(tables.tract_features(spark, sf_dir)),
        tables.demographics(spark, sf_dir),
        tables.internet(spark, sf_dir),
        mapdata.filings_by(offers, "tract"),
        mapdata.wide_half_years(mapdata.half_years(statistics), mapdata.periods_of(statistics)),
    )
    return _steady(mapdata.published(features))


@register("filings_csv")
def _filings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings written as CSV, read back and summarised."""
    path = f"{_scratch(spark)}/filings"
    tables.filings(spark, sf_dir).write.csv(path, header=True)
    return mapdata.filings_by(consumer_filings(read_filings(spark, path)), "county")


@register("census_csv")
def _census_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Populations written as CSV and read back, with shares."""
    path = f"{_scratch(spark)}/census"
    tables.demographics(spark, sf_dir).write.csv(path, header=True)
    numbers = ["total_pop", *[f"{p}_pop" for p in mapdata.POPULATIONS]]
    return _steady(mapdata.population_shares(read_census(spark, path, "geo_id", numbers)))


@register("statistics_files")
def _statistics_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The county level, exported with national ids and read back."""
    root = _scratch(spark)
    number = F.regexp_extract("GEOID", r"\d+", 0)
    table = _level(spark, sf_dir, "counties").withColumn("GEOID", F.lpad(number, 5, "0"))
    table = table.withColumn("year", F.year("date")).persist()
    export.export(table.drop("year"), "counties", root)
    years = [year for (year,) in table.select("year").distinct().collect()]
    table.unpersist()
    parts = [read_statistics(spark, root, "counties", year) for year in years]
    return reduce(DataFrame.unionByName, parts)


@register("map_files")
def _map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tract features written as GeoJSON, one file per state, joined by the map step, written and read back."""
    root = _scratch(spark)
    mapdata.write_features(tables.tract_layer(spark, sf_dir), "tracts", f"{root}/in")
    tables.filings(spark, sf_dir).write.csv(f"{root}/filings", header=True)
    tables.demographics(spark, sf_dir).write.csv(f"{root}/census", header=True)
    tables.internet(spark, sf_dir).write.csv(f"{root}/internet", header=True)
    part = F.regexp_extract("GEOID", r"\d+", 0).cast("bigint")
    table = _level(spark, sf_dir, "tracts").withColumn("GEOID", tables.tract_of(part))
    export.export(table, "tracts", f"{root}/files")
    jobs.run(
        spark,
        ["mapdata", "--start", "2024-01-01", "--end", "2024-12-31", "--layer", "tracts", "--features", f"{root}/in/tracts",
         "--fields", "name", "--census", f"{root}/census", "--internet", f"{root}/internet", "--internet-columns", "broadband",
         "--filings", f"{root}/filings", "--files", f"{root}/files", "--out", f"{root}/out"],
    )
    numbers = ["total_pop", "broadband", "provider_count", "2024_jan_jun_total_dl_samples"]
    found = read_geojson(spark, f"{root}/out/tracts", ["fips", "name", *numbers])
    corner = F.col("rings")[0][2]
    return found.select(
        "fips",
        "name",
        *[F.col(n).cast("double").alias(n.removeprefix("2024_jan_jun_")) for n in numbers],
        corner["x"].alias("x"),
        corner["y"].alias("y"),
    )

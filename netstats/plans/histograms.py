"""From measurement rows to the histogram table of a level."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstats.functions.fingerprint import shard
from netstats.levels import LEVELS, Level
from netstats.limits import DEFAULT, Limits
from netstats.operators.clean import area_keys, clean, level_areas, level_rows
from netstats.operators.sampling import draw
from netstats.operators.skew import hot_groups, profile
from netstats.operators.spatial import Locate, alike, attach_boundary, locate_points, located
from netstats.operators.summary import daily_statistics, histogram
from netstats.schema import histogram_columns


@dataclass(frozen=True)
class Prepared:
    """Cleaned rows with what was found out about their group sizes.

    `parts` is into how many tasks to deal them, if their number is known.
    """

    rows: DataFrame
    hot_addresses: DataFrame | None
    spread_quantiles: bool
    parts: int | None = None


def _parts(rows: DataFrame, rows_at_most: int | None, limits: Limits) -> int | None:
    """As many tasks as there are cores, or as the rows ask for: a sort holds about its task's rows."""
    if rows_at_most is None:
        return None
    spark = rows.sparkSession
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(least, -(-rows_at_most // limits.rows_per_task))


def prepare(
    tests: DataFrame,
    rows_at_most: int | None = None,
    limits: Limits = DEFAULT,
    hashing: str = "md5",
) -> Prepared:
    """Clean once and check group sizes once for any number of levels.

    `rows_at_most` is an upper bound on the number of tests, if one is known (Parquet
    footers give it without reading data). When the bound itself rules out large
    groups, they need not be looked for.
    """
    rows = clean(tests, hashing)
    parts = _parts(rows, rows_at_most, limits)
    smallest = min(limits.tests_per_group, limits.samples_per_group)
    if rows_at_most is not None and rows_at_most <= smallest:
        return Prepared(rows, None, False, parts)
    found = profile(rows)
    hot = None
    if found.tests_per_address > limits.tests_per_group:
        hot = hot_groups(rows, ["date", "direction", "ip"], limits.tests_per_group)
    return Prepared(rows, hot, found.addresses_per_day > limits.samples_per_group, parts)


def layer_lookup(
    rows: DataFrame, boundaries: Mapping[str, DataFrame], layer: str, locate: Locate = locate_points
) -> DataFrame:
    """The polygons of a layer around each coordinate, with the columns that its levels take as keys."""
    attributes = {a for level in LEVELS.values() if level.boundary == layer for a in level.attributes}
    return located(rows, boundaries[layer].drop(*attributes), locate)


def draws(
    level: Level | str,
    prepared: Prepared,
    boundaries: Mapping[str, DataFrame] | None = None,
    limits: Limits = DEFAULT,
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The two drawn tests of every (date, direction, keys, ip) of a level.

    `lookups` has what `layer_lookup` made, for layers that several levels use.
    """
    level = LEVELS[level] if isinstance(level, str) else level
    rows = prepared.rows
    if level.boundary:
        lookup = (lookups or {}).get(level.boundary)
        if lookup is None:
            lookup = layer_lookup(rows, boundaries, level.boundary)
        rows = attach_boundary(rows, lookup)
    # Polygons multiply rows; how many there are then is not known.
    parts = None if level.boundary else prepared.parts
    return draw(level_rows(level, rows), level.keys, prepared.hot_addresses, limits, parts)


def _table_by_area(
    level: Level,
    prepared: Prepared,
    boundaries: Mapping[str, DataFrame] | None,
    quartiles: str,
    limits: Limits,
    lookups: Mapping[str, DataFrame] | None,
) -> DataFrame:
    """The histogram table of a level with polygons.

    Polygons around the same coordinates have the same histograms: these are made once and given to each of them.
    """
    lookup = (lookups or {}).get(level.boundary)
    if lookup is None:
        lookup = layer_lookup(prepared.rows, boundaries, level.boundary)
    given = area_keys(level, lookup.columns)
    around, members = alike(level_areas(level, lookup, given))
    rows = level_rows(level, attach_boundary(prepared.rows, around), given)
    keys = [*[k for k in level.keys if k not in given], "area"]
    drawn = draw(rows, keys, prepared.hot_addresses, limits)
    table = histogram(daily_statistics(drawn, keys, quartiles, prepared.spread_quantiles), keys)
    if level.attributes:
        names = boundaries[level.boundary].select(F.col("geo_id").alias("GEOID"), *level.attributes)
        members = members.join(names, "GEOID")
    if level.shard_by[0] in given:
        members = _sharded(members, level)
    else:
        table = _sharded(table, level)
    # After the shuffle the values are there; before it they would be worked out again for each polygon. Statistics come dealt by
    # the day and the keys: Spark would leave out a shuffle by just these.
    return table.repartition("date", "area").join(members, "area")


def _sharded(table: DataFrame, level: Level) -> DataFrame:
    column, shards = level.shard_by
    return table.withColumn("shard", shard(F.col(column), shards))


def level_histogram(
    level: Level | str,
    prepared: Prepared,
    boundaries: Mapping[str, DataFrame] | None = None,
    quartiles: str = "published",
    limits: Limits = DEFAULT,
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The histogram table of one level.

    Download and upload go through together, and statistics and bucket counts come
    from one aggregation: two shuffles, no joins, no row multiplication before the
    final eight rows per day.
    """
    level = LEVELS[level] if isinstance(level, str) else level
    if level.boundary:
        table = _table_by_area(level, prepared, boundaries, quartiles, limits, lookups)
    else:
        drawn = draws(level, prepared, boundaries, limits, lookups)
        daily = daily_statistics(drawn, level.keys, quartiles, prepared.spread_quantiles, prepared.parts)
        table = _sharded(histogram(daily, level.keys), level)
    return table.select(*histogram_columns(list(level.keys), list(level.attributes)))

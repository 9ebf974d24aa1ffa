"""Plain SQL for the level histograms: one pass per direction, then joins."""

from __future__ import annotations

from netstats.levels import LEVELS, REGION, Level

FP = "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)"


def r(value: str, digits: int = 3) -> str:
    """Round half up on the decimal form of a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 9)), {digits}) AS DOUBLE)"


def r_once(value: str, digits: int = 3) -> str:
    """Round half up, once, on the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


MEASUREMENTS = f"""
measurements AS (
  SELECT CAST(ts AS DATE) AS date,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'dl' ELSE 'ul' END AS direction,
    CASE WHEN event_id % 29 <> 0 THEN {FP.format(
        "CASE WHEN event_id % 31 = 0 THEN 'again' || (user_id % 3) ELSE CAST(event_id AS VARCHAR) END"
    )} END AS fp,
    CASE WHEN event_id % 37 < 2 THEN NULL
      WHEN event_id % 37 = 2
        THEN '2001:0db8:0000:0000:0000:0000:0000:' || lpad(lower(to_hex(user_id % 65536)), 4, '0')
      ELSE (10 + user_id // 16777216) || '.' || (user_id // 65536 % 256) || '.'
        || (user_id // 256 % 256) || '.' || (user_id % 256) END AS ip,
    event_id % 37 <> 0 AS has_ip_text,
    CASE user_id % 53 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE r_name END AS continent_code,
    CASE user_id % 59 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE n_name END AS country_code,
    CASE WHEN user_id % 47 IN (0, 1) THEN NULL WHEN user_id % 47 = 2 OR user_id % 3 = 0 THEN ''
      WHEN user_id % 3 = 1 THEN 'sub' || (user_id % 5) ELSE c_mktsegment END AS subdivision,
    CASE WHEN user_id % 47 IN (1, 3) THEN NULL WHEN user_id % 47 = 2 THEN '' ELSE c_mktsegment END AS region_name,
    country_code || '-' || CASE WHEN subdivision <> '' THEN subdivision ELSE region_name END AS {REGION},
    (subdivision IS NOT NULL OR region_name IS NOT NULL) AND (subdivision <> '' OR region_name <> '') AS region_available,
    CASE user_id % 61 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'city' || (user_id % 7) END AS city,
    CASE WHEN user_id % 67 > 0 THEN user_id % 9 + 64500 END AS asn,
    user_id * 7 % 360 - 180 + 0.5 AS lon, user_id * 5 % 180 - 90 + 0.5 AS lat,
    CASE WHEN event_id % 41 = 0 THEN 0 WHEN event_id % 43 = 0 THEN floor(value) + 0.3424999999::DOUBLE
      ELSE value END AS mbps,
    CAST(props->>'$.k' AS DOUBLE) AS MinRTT
  FROM events
  JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE mbps <> 0
)"""

SHIPMENTS = f"""
measurements AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_linestatus = 'O' THEN 'dl' ELSE 'ul' END AS direction,
    {FP.format("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))")} AS fp,
    TRUE AS has_ip_text, TRUE AS region_available,
    '10.' || (o_custkey // 65536) || '.' || (o_custkey // 256 % 256) || '.' || (o_custkey % 256) AS ip,
    r_name AS continent_code, n_name AS country_code,
    n_name || '-' || c_mktsegment AS {REGION},
    'city' || (o_custkey % 7) AS city,
    l_suppkey AS asn,
    o_custkey * 7 % 360 - 180 + 0.5 AS lon, o_custkey * 5 % 180 - 90 + 0.5 AS lat,
    l_extendedprice / 10 AS mbps, l_quantity AS MinRTT
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE l_extendedprice <> 0
)"""

# Rectangles: low corner, size, and the columns the level takes from the layer.
BOXES = {
    "states": (
        "SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS GEOID, "
        "'S' || n_nationkey AS state, n_name AS state_name, "
        "n_nationkey * 14 - 175 AS x, -80 AS y, 14 AS w, 160 AS h FROM nation"
    ),
    "counties": (
        "SELECT 'C' || s_suppkey AS GEOID, s_suppkey % 36 * 10 - 180 AS x, "
        "s_suppkey // 36 % 30 * 6 - 90 AS y, 10 AS w, 6 AS h FROM supplier"
    ),
    "tracts": (
        "SELECT 'T' || p_partkey AS GEOID, 'State ' || (p_partkey % 50) AS state_name, "
        "'Tract ' || p_partkey AS tract_name, p_type AS lsad_name, p_partkey % 90 * 4 - 180 AS x, "
        "p_partkey // 90 % 60 * 3 - 90 AS y, 4 AS w, 3 AS h FROM part"
    ),
}

COUNTY_NAMES = """
county_names AS (
  SELECT 'C' || s_suppkey AS GEOID, s_name AS county_name,
    lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS state_fips_code,
    CAST(s_suppkey % 1000 AS VARCHAR) AS county_fips_code,
    'G' || s_suppkey AS county_gnis_code, 'County ' || s_suppkey AS lsad_name,
    CAST(s_suppkey % 10 AS VARCHAR) AS lsad_code, 'H1' AS fips_class_code
  FROM supplier
)"""


def located(level: Level) -> str:
    """CTE `tests`: measurement rows with the level's key columns, as far as these are known."""
    known = ["has_ip_text" if level.ip_text_only else "ip IS NOT NULL"]
    if level.has_region:
        known.append("region_available")
    for key in level.keys:
        if key == "asn" or key in level.may_be_empty:
            known.append(f"{key} IS NOT NULL")
        elif key != REGION:
            known.append(f"{key} <> ''")
    state = f"{REGION} AS state, " if level.boundary != "states" else ""
    rows = "SELECT * FROM measurements" if not level.boundary else f"""
  SELECT m.*, {state}b.* EXCLUDE (x, y, w, h)
  FROM measurements m JOIN ({BOXES[level.boundary]}) b
    ON m.lon BETWEEN b.x AND b.x + b.w AND m.lat BETWEEN b.y AND b.y + b.h"""
    return f"tests AS (SELECT * FROM ({rows}) WHERE {' AND '.join(known)})"


def drawn(level: Level) -> str:
    """CTE `drawn`: per direction and address, the number of tests and both draws."""
    group = ", ".join(["date", "direction", *level.keys, "ip"])
    return f"""
placed AS (
  SELECT {group}, mbps, MinRTT,
    row_number() OVER (PARTITION BY {group} ORDER BY fp NULLS FIRST, mbps, MinRTT NULLS FIRST) - 1 AS place,
    count(*) OVER (PARTITION BY {group}) AS tests
  FROM tests
),
drawn AS (
  SELECT {group}, max(tests) AS tests,
    max(CASE WHEN place = 511232941 % tests THEN mbps END) AS mbps_rnd1,
    max(CASE WHEN place = 511232941 % tests THEN MinRTT END) AS MinRTT_rnd1,
    max(CASE WHEN place = 906686609 % tests THEN mbps END) AS mbps_rnd2,
    max(CASE WHEN place = 906686609 % tests THEN MinRTT END) AS MinRTT_rnd2
  FROM placed GROUP BY {group}
)"""


def _geometric_mean(column: str) -> str:
    return f"pow(10, avg(CASE WHEN {column} > 0 THEN log10({column}) END))"


def stats(level: Level, short: str, long: str, quartiles: tuple[int, int, int]) -> str:
    by = ", ".join(["date", *level.keys])
    q25, q50, q75 = (f"{q / 100}" for q in quartiles)
    return f"""
{short}_stats AS (
  SELECT {by}, count(*) AS {short}_samples_day,
    {r(_geometric_mean("mbps_rnd1"))} AS {short}_LOG_AVG_rnd1,
    {r(_geometric_mean("mbps_rnd2"))} AS {short}_LOG_AVG_rnd2,
    {r(_geometric_mean("MinRTT_rnd1"))} AS {short}_minRTT_LOG_AVG_rnd1,
    {r(_geometric_mean("MinRTT_rnd2"))} AS {short}_minRTT_LOG_AVG_rnd2,
    {r_once("min(mbps_rnd1)")} AS {long}_MIN,
    {r_once(f"quantile_disc(mbps_rnd1, {q25})")} AS {long}_Q25,
    {r_once(f"quantile_disc(mbps_rnd1, {q50})")} AS {long}_MED,
    {r("avg(mbps_rnd1)")} AS {long}_AVG,
    {r_once(f"quantile_disc(mbps_rnd1, {q75})")} AS {long}_Q75,
    {r_once("max(mbps_rnd1)")} AS {long}_MAX,
    {r_once(f"quantile_disc(MinRTT_rnd1, {q50})")} AS {long}_minRTT_MED
  FROM drawn WHERE direction = '{short}' GROUP BY {by}
)"""


def bucket_counts(level: Level, short: str) -> str:
    by = ", ".join(["date", *level.keys])
    inside = "mbps_rnd1 >= l AND mbps_rnd1 < u"
    return f"""
{short}_histogram AS (
  SELECT {by}, CASE WHEN b = 0 THEN 0.0::DOUBLE ELSE l END AS bucket_min, u AS bucket_max,
    count(*) FILTER (WHERE {inside}) AS {short}_samples_bucket,
    {r(f"count(*) FILTER (WHERE {inside}) / count(*)")} AS {short}_frac_bucket
  FROM drawn CROSS JOIN buckets WHERE direction = '{short}' GROUP BY {by}, b, l, u
)"""


BUCKETS = """
buckets AS (
  SELECT b, pow(10, b * 0.5 - 0.25) AS l, pow(10, b * 0.5 + 0.25) AS u FROM range(8) t(b)
)"""


def level_ctes(
    level: Level, source: str = MEASUREMENTS, quartiles: tuple[int, int, int] = (24, 49, 74)
) -> list[str]:
    return [
        source,
        located(level),
        drawn(level),
        BUCKETS,
        stats(level, "dl", "download", quartiles),
        stats(level, "ul", "upload", quartiles),
        bucket_counts(level, "dl"),
        bucket_counts(level, "ul"),
    ]


def level_body(level: Level) -> str:
    by = ", ".join(["date", *level.keys])
    column, shards = level.shard_by
    names = "JOIN county_names USING (GEOID)" if level.attributes else ""
    fp = FP.format(f"CAST({column} AS VARCHAR)")
    return f"""
SELECT *, {fp} % {shards} AS shard
FROM dl_histogram
JOIN ul_histogram USING ({by}, bucket_min, bucket_max)
JOIN dl_stats USING ({by})
JOIN ul_stats USING ({by})
{names}"""


def level_sql(
    name: str, source: str = MEASUREMENTS, quartiles: tuple[int, int, int] = (24, 49, 74)
) -> str:
    level = LEVELS[name]
    ctes = level_ctes(level, source, quartiles)
    if level.attributes:
        ctes.append(COUNTY_NAMES)
    return "WITH " + ",".join(ctes) + level_body(level)

"""Plain SQL for each registered query that SQL can express on whole tables."""

from __future__ import annotations

from netstats.levels import LEVELS
from netstats.schema import BUCKET_COLUMNS, daily_columns, histogram_columns
from workload.fleet_sql import CLIENTS_SQL, NUMBERED_SQL, RATE_SQL, STATS_SQL
from workload.level_sql import (
    COUNTY_NAMES,
    FP,
    MEASUREMENTS,
    SHIPMENTS,
    drawn,
    level_body,
    level_ctes,
    level_sql,
    located,
)

ORACLES: dict[str, str] = {f"level_{name}": level_sql(name) for name in LEVELS}
ORACLES["level_continents_documented_quartiles"] = level_sql("continents", quartiles=(25, 50, 75))
for _name in ("continents", "countries_asn", "global_asn"):
    ORACLES[f"shipments_{_name}"] = level_sql(_name, SHIPMENTS)
ORACLES["refreshed_table"] = (
    f"SELECT *, CAST(year(date) AS INTEGER) AS year FROM ({level_sql('countries')})"
)

for _name in ("continents", "countries_asn", "regions", "states", "counties"):
    ORACLES[f"level_{_name}_spread"] = level_sql(_name)
ORACLES["level_states_from_text"] = level_sql("states")

_cities_asn = LEVELS["cities_asn"]
ORACLES["clean_rows"] = f"""WITH {MEASUREMENTS}, {located(_cities_asn)}
SELECT date, direction, {", ".join(_cities_asn.keys)}, ip, fp, mbps, MinRTT FROM tests"""

ORACLES["parse_addresses"] = """
WITH texts AS (
  SELECT event_id % 6 AS kind, user_id % 65536 AS u FROM events
),
parsed AS (
  SELECT CASE kind
      WHEN 0 THEN '10.0.' || (u // 256) || '.' || (u % 256)
      WHEN 1 THEN '2001:0db8:0000:0000:0000:0000:0000:' || lpad(lower(to_hex(u)), 4, '0')
      WHEN 2 THEN '2001:0db8:0000:0000:0000:0000:0000:' || lpad(lower(to_hex(u)), 4, '0')
      WHEN 3 THEN '0000:0000:0000:0000:0000:ffff:0a00:' || lpad(lower(to_hex(u)), 4, '0')
    END AS ip,
    CASE kind WHEN 4 THEN 'a' || u WHEN 5 THEN 'b' || (u % 256) ELSE 'c' || kind END AS spelling
  FROM texts
)
SELECT ip, count(*) AS tests, count(DISTINCT spelling) AS spellings FROM parsed GROUP BY ip"""

ORACLES["ip_sample"] = f"""WITH {MEASUREMENTS}, {located(LEVELS["countries"])}, {drawn(LEVELS["countries"])}
SELECT * FROM drawn"""


def _columns_of_level(name: str, columns: list[str]) -> str:
    keys = ", ".join(["date", *LEVELS[name].keys])
    return f"SELECT {keys}, {', '.join(columns)} FROM ({level_sql(name)})"


ORACLES["log_histogram"] = _columns_of_level("countries_asn", BUCKET_COLUMNS)

_regions = LEVELS["regions"]
ORACLES["daily_stats"] = (
    "WITH "
    + ",".join(level_ctes(_regions)[:6])
    + f"""SELECT date, {", ".join(_regions.keys)}, {", ".join(daily_columns("dl") + daily_columns("ul"))}
FROM dl_stats JOIN ul_stats USING (date, {", ".join(_regions.keys)})"""
)
ORACLES["shard_sizes"] = f"""
SELECT shard, count(*) AS rows FROM ({level_sql("cities")}) GROUP BY shard"""
ORACLES["geographies"] = f"""
SELECT DISTINCT {", ".join(_regions.keys)} FROM ({level_sql("regions")})"""


def _files_sql(name: str, path: str, order: str) -> str:
    level = LEVELS[name]
    columns = histogram_columns(list(level.keys), list(level.attributes))[:-1] + ["year"]
    fields = ", ".join(f'"{c}" := "{c}"' for c in sorted(columns))
    return f"""
WITH rows AS (SELECT *, CAST(year(date) AS INTEGER) AS year FROM ({level_sql(name)})),
lines AS (
  SELECT *, {path} AS path, CAST(to_json(struct_pack({fields})) AS VARCHAR) AS line FROM rows
)
SELECT path, '[' || string_agg(line, ',' ORDER BY {order}, line) || ']' AS content
FROM lines GROUP BY path"""


ORACLES["export_json"] = _files_sql(
    "countries",
    "'v0/' || continent_code || '/' || country_code || '/' || year || '/histogram_daily_stats.json'",
    "date, bucket_min",
)
ORACLES["exported_files"] = _files_sql(
    "counties",
    "'v0/NA/US/counties/' || GEOID || '/' || year || '/histogram_daily_stats.json'",
    "date, bucket_min",
)

_region_files = _files_sql(
    "regions",
    "'v0/' || continent_code || '/' || country_code || '/' || \"ISO3166_2region1\" || '/' || year || '/histogram_daily_stats.json'",
    "date, bucket_min",
)
ORACLES["exported_shard"] = _region_files.replace(
    "WITH rows AS (",
    f"""WITH sizes AS (SELECT shard, count(*) AS n FROM ({level_sql("regions")}) GROUP BY shard),
rows AS (SELECT * FROM (""",
    1,
).replace(
    "),\nlines AS",
    ") WHERE shard = (SELECT shard FROM sizes ORDER BY n DESC, shard LIMIT 1)),\nlines AS",
    1,
)
ORACLES["level_countries_from_files"] = f"""
SELECT * FROM ({level_sql("countries")}) WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""
ORACLES["level_continents_sketch"] = level_sql("continents")
_continents = LEVELS["continents"]
ORACLES["monthly_quantiles"] = f"""WITH {SHIPMENTS}, {located(_continents)}, {drawn(_continents)}
SELECT CAST(date_trunc('month', date) AS DATE) AS month, continent_code, direction, count(*) AS samples, TRUE AS within_bound
FROM drawn GROUP BY ALL"""

ORACLES["pip_join"] = """
WITH points AS (
  SELECT c_custkey, c_custkey * 7919 % 36000 / 100.0::DOUBLE - 180 + 0.005::DOUBLE AS lon,
    c_custkey * 104729 % 18000 / 100.0::DOUBLE - 90 + 0.005::DOUBLE AS lat
  FROM customer
),
shapes AS (
  SELECT 'D' || s_suppkey AS geo_id, s_suppkey * 37 % 340 - 170 AS cx, s_suppkey * 17 % 160 - 80 AS cy
  FROM supplier
),
pairs AS (
  SELECT c_custkey, geo_id, abs(lon - cx) / 7.3137 + abs(lat - cy) / 5.7091 AS d
  FROM points JOIN shapes ON lon BETWEEN cx - 8 AND cx + 8 AND lat BETWEEN cy - 6 AND cy + 6
)
SELECT c_custkey, geo_id FROM pairs WHERE d < 1 AND d > 0.25"""

# The latitude at which the great circle through both ends of an edge meets the point's meridian.
ORACLES["pip_sphere"] = """
WITH points AS (
  SELECT c_custkey, c_custkey * 7919 % 36000 / 100.0::DOUBLE - 180 + 0.005::DOUBLE AS lon,
    c_custkey * 104729 % 18000 / 100.0::DOUBLE - 90 + 0.005::DOUBLE AS lat
  FROM customer
),
turn AS (SELECT * FROM (VALUES (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) t(ax, ay, tx, ty)),
scales AS (SELECT * FROM (VALUES (1.0::DOUBLE), (0.25::DOUBLE)) s(scale)),
centres AS (SELECT s_suppkey, s_suppkey * 37 % 360 - 180 AS cx, s_suppkey * 17 % 150 - 75 AS cy FROM supplier),
quarters AS (SELECT * FROM (VALUES (0), (90), (180), (270)) q(quarter)),
edges AS (
  SELECT 'D' || s_suppkey AS geo_id, FALSE AS north,
    cx + ax * 23.137::DOUBLE * scale AS x1, radians(cy + ay * 9.091::DOUBLE * scale) AS y1,
    cx + tx * 23.137::DOUBLE * scale AS x2, radians(cy + ty * 9.091::DOUBLE * scale) AS y2
  FROM centres, turn, scales
  UNION ALL
  SELECT 'P' || n_nationkey, n_nationkey % 2 = 0,
    n_nationkey * 7 - 180 + quarter,
    radians(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 45.25::DOUBLE ELSE -45.25::DOUBLE - n_nationkey END),
    n_nationkey * 7 - 90 + quarter,
    radians(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 45.25::DOUBLE ELSE -45.25::DOUBLE - n_nationkey END)
  FROM nation, quarters
),
seen AS (
  SELECT c_custkey, lat, geo_id, north, y1, y2,
    x1 - lon - 360 * floor((x1 - lon + 180) / 360) AS d1, x2 - lon - 360 * floor((x2 - lon + 180) / 360) AS d2
  FROM points, edges
),
counted AS (
  SELECT c_custkey, geo_id, north, count(*) FILTER (WHERE (d1 > 0) <> (d2 > 0) AND abs(d1 - d2) < 180
    AND degrees(atan((tan(y1) * sin(radians(d2)) - tan(y2) * sin(radians(d1))) / sin(radians(d2 - d1)))) > lat) AS n
  FROM seen GROUP BY ALL
)
SELECT c_custkey, geo_id FROM counted WHERE (n % 2 = 1) <> north"""

ORACLES["dissolve_edges"] = """
WITH squares AS (
  SELECT p_partkey % 40 AS x, p_partkey // 40 AS y FROM part
),
edges AS (
  SELECT x, y, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM squares
  UNION ALL SELECT x, y, x, y + 1, x + 1, y + 1 FROM squares
  UNION ALL SELECT x, y, x, y, x, y + 1 FROM squares
  UNION ALL SELECT x, y, x + 1, y, x + 1, y + 1 FROM squares
)
SELECT (x // 4) || '-' || (y // 5) AS tract, min(CAST(y // 50 AS VARCHAR)) AS state,
  CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
FROM edges GROUP BY x // 4, y // 5, x1, y1, x2, y2 HAVING count(*) = 1"""

_GAPS = """
squares AS (
  SELECT p_partkey % 40 AS x, p_partkey // 40 AS y, ((p_partkey % 40) // 4) || '-' || (p_partkey // 200) AS tract
  FROM part WHERE p_partkey % 11 <> 5
)"""

ORACLES["dissolved_rings"] = f"""
WITH RECURSIVE {_GAPS},
edges AS (
  SELECT tract, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM squares
  UNION ALL SELECT tract, x + 1, y, x + 1, y + 1 FROM squares
  UNION ALL SELECT tract, x + 1, y + 1, x, y + 1 FROM squares
  UNION ALL SELECT tract, x, y + 1, x, y FROM squares
),
once AS (
  SELECT * FROM edges a WHERE NOT EXISTS (
    SELECT 1 FROM edges b WHERE b.tract = a.tract AND b.x1 = a.x2 AND b.y1 = a.y2 AND b.x2 = a.x1 AND b.y2 = a.y1)
),
walk AS (
  SELECT tract, x1 AS sx, y1 AS sy, x1 AS x, y1 AS y FROM once
  UNION SELECT walk.tract, sx, sy, x2, y2 FROM walk JOIN once ON once.tract = walk.tract AND x1 = x AND y1 = y
),
leads AS (SELECT tract, sx, sy, min((x, y)) AS lead FROM walk GROUP BY ALL),
rings AS (
  SELECT once.tract, lead, sum(x1 * y2 - x2 * y1) / 2.0 AS area, count(*) AS corners
  FROM once JOIN leads ON leads.tract = once.tract AND sx = x1 AND sy = y1 GROUP BY ALL
)
SELECT tract, area < 0 AS hole, CAST(abs(area) AS DOUBLE) AS area, CAST(corners AS INTEGER) AS corners,
  CAST(lead[1] AS DOUBLE) AS x, CAST(lead[2] AS DOUBLE) AS y
FROM rings"""

ORACLES["points_in_dissolved"] = f"""
WITH {_GAPS} SELECT x + 0.5::DOUBLE AS lon, y + 0.5::DOUBLE AS lat, tract AS geo_id FROM squares"""

_CONNECTIONS = """
connections AS (
  SELECT CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'u' || (o_orderkey // 2) END AS UUID,
    o_orderdate + INTERVAL 8401 DAY + to_seconds(o_orderkey % 86400) AS t,
    CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'site' || (o_custkey % 5) END AS site,
    o_orderkey % 19 <> 0 AS has_geo, o_custkey, o_orderkey
  FROM orders
),
usable AS (
  SELECT *, CAST(t AS DATE) AS day FROM connections
  WHERE UUID <> '' AND site <> '' AND has_geo AND o_orderkey % 4 <= 2
    AND CAST(t AS DATE) BETWEEN DATE '2018-01-01' AND DATE '2020-03-10'
),
annotated AS (
  SELECT DISTINCT 'u' || (o_orderkey // 2) AS id,
    CAST(o_orderdate + INTERVAL 8401 DAY + to_seconds(o_orderkey % 86400) AS DATE) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'
),
missing AS (
  SELECT UUID, day, min(t) AS t, arg_min(site, (t, site)) AS site,
    arg_min(o_custkey, (t, site, o_custkey % 9, o_custkey % 25, o_custkey % 7)) AS cust
  FROM usable LEFT JOIN annotated ON UUID = id AND day = date
  WHERE id IS NULL GROUP BY UUID, day
)"""

ORACLES["anti_join_connections"] = f"""WITH {_CONNECTIONS}
SELECT UUID, strftime(t, '%Y-%m-%d %H:%M:%S') AS first_time, site, cust % 9 AS server_asn,
  'N' || (cust % 25) AS client_country, strftime(day, '%Y/%m/%d') AS year_month_day
FROM missing"""


def _asn_json(number: str) -> str:
    """A network object; an AS number of 0 is left out."""
    return (
        f"""'{{' || CASE WHEN {number} = 0 THEN '' ELSE '"ASNumber":' || {number} || ',' END """
        f"""|| '"ASName":"AS' || {number} || '"}}'"""
    )


ORACLES["connection_files"] = f"""WITH {_CONNECTIONS}
SELECT strftime(day, '%Y/%m/%d') || '/' || UUID || '.json' AS path,
  '{{"UUID":"' || UUID || '","Timestamp":"' || strftime(t, '%Y-%m-%dT%H:%M:%SZ')
  || '","Server":{{"Site":"' || site || '","Machine":"node1","Geo":{{"CountryCode":"N' || (cust % 25)
  || '"}},"Network":' || {_asn_json("(cust % 9)")}
  || '}},"Client":{{"Geo":{{"CountryCode":"N' || (cust % 25) || '"}},"Network":'
  || {_asn_json("(cust % 7)")} || '}}}}' AS content
FROM missing"""

_HOP_ID = (
    "CASE WHEN l_partkey % 23 = 0 THEN '' WHEN l_partkey % 7 = 0 THEN 'plain' || l_partkey "
    "ELSE '2021_host' || (l_suppkey % 50) || '_' || l_partkey END"
)
_TRACE_TIME = "o_orderdate + INTERVAL 8900 DAY + to_seconds(o_orderkey % 86400)"
_HOPS = f"""
hops AS (
  SELECT {_HOP_ID} AS ID, CAST({_TRACE_TIME} AS DATE) AS day,
    {_TRACE_TIME} + to_seconds(l_linenumber) AS t,
    'N' || (l_suppkey % 25) AS country, l_suppkey % 9 AS asn,
    '10.1.' || (l_suppkey % 256) || '.' || l_linenumber AS IP
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_partkey % 29 <> 0 AND o_orderkey % 4 <= 2
    AND CAST({_TRACE_TIME} AS DATE) BETWEEN DATE '2019-03-29' AND DATE '2021-09-08'
),
annotated AS (
  SELECT DISTINCT {_HOP_ID} AS id_known,
    CAST({_TRACE_TIME} AS DATE) + CAST(l_linenumber % 3 - 1 AS INTEGER) AS date_known
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N'
),
unknown AS (
  SELECT hops.* FROM hops
  LEFT JOIN annotated ON ID = id_known AND date_known BETWEEN day - 1 AND day + 1
  WHERE ID <> '' AND id_known IS NULL
),
ranked AS (
  SELECT *, CAST(t AS DATE) AS hop_day,
    row_number() OVER (PARTITION BY ID, CAST(t AS DATE) ORDER BY t, country, asn, IP) AS rank
  FROM unknown
),
missing AS (
  SELECT *, nullif(regexp_extract(ID, '.+_(.+)_.+', 1), '') AS host FROM ranked WHERE rank = 1
)"""

ORACLES["anti_join_hops"] = f"""WITH {_HOPS}
SELECT ID, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS first_time, country,
  strftime(hop_day, '%Y/%m/%d') AS hop_date, strftime(t, '%Y%m%dT000000Z') AS FilenameTimestamp,
  host AS Hostname, IP
FROM missing"""
ORACLES["hop_files"] = f"""WITH {_HOPS}
SELECT strftime(hop_day, '%Y/%m/%d') || '/' || strftime(t, '%Y%m%dT000000Z') || '_'
    || coalesce(host, '<no value>') || '_' || IP || '.json' AS path,
  '{{"ID":"' || ID || '","Timestamp":"' || strftime(t, '%Y-%m-%dT%H:%M:%SZ')
  || '","Annotations":{{"Geo":{{"CountryCode":"' || country || '","Longitude":2}},"Network":'
  || {_asn_json("asn")} || '}}}}' AS content
FROM missing"""

ORACLES["backfill_days_connections"] = """
SELECT DISTINCT CAST(o_orderdate + INTERVAL 8401 DAY AS DATE) AS date FROM orders
WHERE o_orderdate + INTERVAL 8401 DAY < TIMESTAMP '2020-03-11'"""
ORACLES["backfill_days_hops"] = """
SELECT DISTINCT CAST(o_orderdate + INTERVAL 8900 DAY AS DATE) AS date
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate + INTERVAL 8900 DAY AS DATE) BETWEEN DATE '2019-03-29' AND DATE '2021-09-08'"""

ORACLES["canary_numbered"] = NUMBERED_SQL
ORACLES["canary_numbered_spread"] = f"""
SELECT ID, machineSample, machineCount, siteSample, siteCount, metroSample, metroCount
FROM ({NUMBERED_SQL})"""
ORACLES["canary_stats_spread"] = STATS_SQL
ORACLES["canary_rate"] = RATE_SQL
ORACLES["fleet_clients"] = CLIENTS_SQL
ORACLES["canary_stats"] = STATS_SQL

_BLOCK = "lpad(CAST({0} * 982451653 AS VARCHAR), 15, '0')"


def _filings_cte(digits: int) -> str:
    return f"""
offers AS (
  SELECT left({_BLOCK.format("l_partkey")}, {digits}) AS geo_id, l_suppkey AS provider,
    CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity END AS down, l_quantity / 2 AS up
  FROM lineitem WHERE l_linestatus = 'O'
),
filings AS (
  SELECT geo_id, count(DISTINCT provider) AS provider_count, avg(down) AS mean_max_ad_down,
    avg(up) AS mean_max_ad_up, count(*) AS source_rows
  FROM offers GROUP BY geo_id
)"""


for _name, _digits in (("block", 15), ("tract", 11), ("county", 5)):
    ORACLES[f"filings_by_{_name}"] = f"WITH {_filings_cte(_digits)} SELECT * FROM filings"


def _statistics_cte(digits: int) -> str:
    return f"""
statistics AS (
  SELECT left({_BLOCK.format("l_partkey")}, {digits}) AS fips, CAST(l_shipdate AS DATE) AS date,
    CASE l_linenumber WHEN 1 THEN 0.0 WHEN 2 THEN 1.7782794100389228 WHEN 3 THEN 5.623413251903491
      WHEN 4 THEN 17.78279410038923 ELSE 56.23413251903491 END AS bucket_min,
    CAST(l_quantity AS BIGINT) AS dl_samples_bucket, l_extendedprice / 10 AS download_MED,
    l_suppkey % 40 AS ul_samples_bucket, l_extendedprice / 20 AS upload_MED
  FROM lineitem
)"""


_SUMMARY = """
days AS (
  SELECT fips, date,
    year(date) || CASE WHEN month(date) <= 6 THEN '_jan_jun' ELSE '_july_dec' END AS period,
    arg_min(download_MED, (bucket_min, download_MED, upload_MED)) AS dl_med,
    arg_min(upload_MED, (bucket_min, download_MED, upload_MED)) AS ul_med,
    sum(dl_samples_bucket) AS dl, sum(ul_samples_bucket) AS ul,
    coalesce(sum(dl_samples_bucket) FILTER (WHERE bucket_min > 2.5), 0) AS audio,
    coalesce(sum(dl_samples_bucket) FILTER (WHERE bucket_min > 10), 0) AS video
  FROM statistics GROUP BY ALL
),
summary AS (
  SELECT fips AS geo_id, period, round(median(dl_med), 6) AS median_dl,
    round(median(ul_med), 6) AS median_ul,
    CAST(sum(dl) AS BIGINT) AS total_dl_samples, CAST(sum(ul) AS BIGINT) AS total_ul_samples,
    round(sum(audio) / nullif(sum(dl), 0), 6) AS percent_over_audio_threshold,
    round(sum(video) / nullif(sum(dl), 0), 6) AS percent_over_video_threshold
  FROM days GROUP BY fips, period
)"""

ORACLES["halfyear_summary"] = f"WITH {_statistics_cte(5)}, {_SUMMARY} SELECT * FROM summary"
ORACLES["halfyear_from_levels"] = f"""
WITH statistics AS (
  SELECT continent_code AS fips, date, bucket_min, dl_samples_bucket, "download_MED",
    ul_samples_bucket, "upload_MED"
  FROM ({level_sql("continents", SHIPMENTS)})
), {_SUMMARY} SELECT * FROM summary"""

_VALUES = (
    "median_dl", "median_ul", "total_dl_samples", "total_ul_samples",
    "percent_over_audio_threshold", "percent_over_video_threshold",
)


# The half-years of the line items.
_HALF_YEARS = [f"{year}_{half}" for year in range(1995, 2002) for half in ("jan_jun", "july_dec")]


def _wide(digits: int) -> str:
    """The summary with a column for each half-year and each value."""
    values = ", ".join(
        f"max({v}) FILTER (WHERE period = '{p}') AS \"{p}_{v}\"" for p in _HALF_YEARS for v in _VALUES
    )
    return f"(WITH {_statistics_cte(digits)}, {_SUMMARY} SELECT geo_id, {values} FROM summary GROUP BY geo_id)"


ORACLES["halfyear_wide"] = f"SELECT * FROM {_wide(5)}"

_POPULATIONS = {"white": 32, "black": 16, "asian": 8, "hispanic": 4, "amerindian": 2}
_counts = ", ".join(
    f"CAST(p_size * {n} AS DOUBLE) AS {g}_pop" for g, n in _POPULATIONS.items()
)
_shares = ", ".join(
    f"round({g}_pop / nullif(total_pop, 0), 6) AS {g}_pct" for g in _POPULATIONS
)
ORACLES["map_join"] = f"""
WITH {_filings_cte(11)},
features AS (SELECT left({_BLOCK.format("p_partkey")}, 11) AS fips, p_name AS name FROM part),
people AS (
  SELECT left({_BLOCK.format("p_partkey")}, 11) AS geo_id, {_counts},
    CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 64 END AS DOUBLE) AS total_pop
  FROM part WHERE p_partkey % 4 > 0
),
internet AS (
  SELECT left({_BLOCK.format("p_partkey")}, 11) AS fips, p_retailprice AS broadband
  FROM part WHERE p_partkey % 3 > 0
)
SELECT f.*, p.* EXCLUDE (geo_id), {_shares}, i.broadband, g.* EXCLUDE (geo_id), w.* EXCLUDE (geo_id)
FROM features f
LEFT JOIN people p ON f.fips = p.geo_id
LEFT JOIN internet i ON f.fips = i.fips
LEFT JOIN filings g ON f.fips = g.geo_id
LEFT JOIN {_wide(11)} w ON f.fips = w.geo_id"""

ORACLES["filings_csv"] = ORACLES["filings_by_county"]
ORACLES["census_csv"] = f"""
WITH people AS (
  SELECT left({_BLOCK.format("p_partkey")}, 11) AS geo_id, {_counts},
    CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 64 END AS DOUBLE) AS total_pop
  FROM part WHERE p_partkey % 4 > 0
)
SELECT *, {_shares} FROM people"""
ORACLES["statistics_files"] = f"""
SELECT lpad(substr(GEOID, 2), 5, '0') AS fips, CAST(date AS VARCHAR) AS date, bucket_min,
  dl_samples_bucket, "download_MED", ul_samples_bucket, "upload_MED"
FROM ({level_sql("counties")})"""
ORACLES["map_files"] = f"""
WITH {_filings_cte(11)},
samples AS (
  SELECT left({_BLOCK.format("CAST(substr(GEOID, 2) AS BIGINT)")}, 11) AS fips,
    CAST(sum(dl_samples_bucket) AS DOUBLE) AS total_dl_samples
  FROM ({level_sql("tracts")}) WHERE year(date) = 2024 AND month(date) <= 6 GROUP BY 1
)
SELECT f.fips, f.p_name AS name,
  CASE WHEN p_partkey % 4 > 0 THEN CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 64 END AS DOUBLE) END AS total_pop,
  CASE WHEN p_partkey % 3 > 0 THEN p_retailprice END AS broadband,
  CAST(g.provider_count AS DOUBLE) AS provider_count, s.total_dl_samples,
  CAST(p_partkey % 90 * 4 - 176 AS DOUBLE) AS x, CAST(p_partkey // 90 % 60 * 3 - 87 AS DOUBLE) AS y
FROM (SELECT *, left({_BLOCK.format("p_partkey")}, 11) AS fips FROM part) f
LEFT JOIN filings g ON f.fips = g.geo_id
LEFT JOIN samples s ON f.fips = s.fips"""

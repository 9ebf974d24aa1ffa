"""Plain SQL for fleet health."""

from __future__ import annotations

from workload.level_sql import FP, r

_HASHED = (
    "concat_ws('_', client_ip, coalesce(name, 'none'), coalesce(os, 'none'), "
    "coalesce(arch, 'none'), coalesce(version, 'none'), coalesce(library, 'none'), 'none', "
    "CASE WHEN wscale IS NULL THEN '-1' ELSE lpad(lower(to_hex(wscale)), 2, '0') END)"
)

RAW = """
raw AS (
  SELECT CASE WHEN event_id % 11 = 0 THEN 'x' || event_id
      ELSE 'ndt-v' || (event_id % 3) || '-' || event_id END AS ID,
    CAST(ts AS DATE) AS date, event_type || (user_id % 2) AS site, left(event_type, 3) AS metro,
    'node' || (user_id % 4) AS machine, n_name AS country, CASE WHEN user_id % 67 > 0 THEN 'AS' || (user_id % 9 + 64500) END AS asname,
    CASE WHEN user_id % 50 = 7 THEN '45.56.98.222'
      ELSE (10 + user_id // 16777216) || '.' || (user_id // 65536 % 256) || '.'
        || (user_id // 256 % 256) || '.' || (user_id % 256) END AS client_ip,
    user_id % 50 = 7 AS is_monitoring,
    CASE WHEN user_id % 5 <> 0 THEN 'name' || (user_id % 3) END AS name,
    'os' || (user_id % 2) AS os,
    CASE WHEN user_id % 4 <> 0 THEN 'x86' END AS arch,
    'lib' AS library, 'v' || (user_id % 2) AS version,
    event_id % 5 AS snapshots,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 120
      WHEN user_id % 10 < 9 THEN 7 END AS wscale,
    CASE WHEN event_id % 5 > 0
      THEN (event_id % 12 * 1000000 + (event_id % 5 - 1) * 100000) / 1000000 END AS elapsed,
    event_id % 3 > 0 AS is_download,
    CASE WHEN event_id % 13 > 0 THEN CAST(event_id AS VARCHAR) END AS uuid,
    value AS mbps, CAST(props->>'$.k' AS DOUBLE) AS MinRTT, event_id % 8 / 8.0::DOUBLE AS loss
  FROM events
  JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey
)"""

ALL_TESTS = f"""
all_tests AS (
  SELECT *, nullif(regexp_extract(ID, '(ndt-?.*)-.*', 1), '') AS ndt_version,
    {FP.format("ID")} AS fp, lpad(to_hex({FP.format(_HASHED)}), 16, ' ') AS endpoint
  FROM raw
)"""

_CLIENT = "client_ip, name, os, version, arch, library, wscale, ndt_version, is_download"
_ORDER = "ORDER BY snapshots DESC NULLS LAST, fp"


def _window(alias: str, keys: str) -> str:
    return f"{alias} AS (PARTITION BY date, {keys}, {_CLIENT})"


NUMBERED = f"""
numbered AS (
  SELECT *,
    row_number() OVER (machine_part {_ORDER}) AS machineSample,
    count(*) OVER machine_part AS machineCount,
    row_number() OVER (site_part {_ORDER}) AS siteSample,
    count(*) OVER site_part AS siteCount,
    row_number() OVER (metro_part {_ORDER}) AS metroSample,
    count(*) OVER metro_part AS metroCount
  FROM all_tests
  WINDOW {_window("machine_part", "site, machine")}, {_window("site_part", "site")},
    {_window("metro_part", "metro")}
)"""

RATED = """
panel AS (
  SELECT * FROM numbered
  WHERE NOT is_monitoring AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
),
endpoint_tests AS (
  SELECT metro, endpoint, is_download, count(*) AS tests FROM panel GROUP BY ALL
),
metro_days AS (
  SELECT metro, is_download, count(DISTINCT date) AS days FROM panel GROUP BY ALL
),
rated AS (
  SELECT panel.*, tests / days AS frequency
  FROM panel JOIN endpoint_tests USING (metro, endpoint, is_download)
  JOIN metro_days USING (metro, is_download)
)"""

NUMBERED_SQL = f"""WITH {RAW}, {ALL_TESTS}, {NUMBERED}
SELECT ID, endpoint AS endpointHash, ndt_version AS NDTVersion, elapsed AS elapsedTime,
  is_monitoring AS isMonitoring, coalesce(wscale, -1) AS WScale, metro AS Metro,
  machineSample, machineCount, siteSample, siteCount, metroSample, metroCount
FROM numbered"""

RATE_SQL = f"""WITH {RAW}, {ALL_TESTS}, {NUMBERED}, {RATED}
SELECT ID, frequency AS metroFrequency FROM rated"""


CLIENTS_SQL = f"""WITH {RAW}, {ALL_TESTS}, {NUMBERED}, {RATED}
SELECT metro AS "Metro", count(DISTINCT endpoint) AS clients, true AS within_bound FROM panel GROUP BY metro"""


def _share(condition: str) -> str:
    return r(f"count(*) FILTER (WHERE {condition}) / nullif(count(uuid), 0)")


def _between(low: int, high: int) -> str:
    return _share(f"mbps BETWEEN {low} AND {high}")


_X = "CASE WHEN MinRTT > 0 AND mbps > 0 THEN -ln(MinRTT) END"
_Y = "CASE WHEN MinRTT > 0 AND mbps > 0 THEN ln(mbps) END"

STATS_SQL = f"""WITH {RAW}, {ALL_TESTS}, {NUMBERED}, {RATED},
samples AS (
  SELECT date AS test_date, country AS "countryName", asname AS "ASName", metro, site, machine,
    name AS "clientName", os AS "clientOS", frequency > 9 AS "clientIsHot",
    CASE WHEN wscale IS NULL THEN '-1' ELSE lpad(to_hex(wscale), 2, '0') END AS "clientWScale",
    ndt_version AS "NDTVersion", elapsed BETWEEN 7 AND 10.1 AS complete, mbps <= 0.1 AS slow,
    endpoint, uuid, mbps, MinRTT, loss
  FROM rated
  WHERE is_download AND (machineSample = 1 OR (machineSample = 2 AND wscale = 120))
)
SELECT test_date, DATE '2024-02-01' AS compute_date, "countryName", "ASName", metro, site, machine,
  "clientName", "clientOS", "clientIsHot", "clientWScale", "NDTVersion", complete, slow,
  count(DISTINCT endpoint) AS clients, count(DISTINCT endpoint) AS endpoints, count(uuid) AS tests,
  {r("exp(avg(CASE WHEN mbps > 0 THEN ln(mbps) END))", 2)} AS log_mean_speed,
  {_share("MinRTT < 10")} AS "rttUnder10msec",
  {r("quantile_disc(MinRTT, 50 / 101.0)")} AS "medianMinRTT",
  {r("avg(CASE WHEN MinRTT < 10000 THEN MinRTT END)")} AS "meanMinRTT",
  {r("exp(avg(CASE WHEN MinRTT > 0 THEN ln(MinRTT) ELSE 0 END))")} AS "logMeanMinRTT",
  avg(loss) AS "AvgLossRate",
  CASE WHEN count({_X}) < 2 THEN NULL
    WHEN stddev_pop({_X}) = 0 OR stddev_pop({_Y}) = 0 THEN 'nan'::DOUBLE
    ELSE {r(f"corr({_X}, {_Y})")} END AS pearson,
  {r("quantile_disc(mbps, 10 / 101.0)", 2)} AS q10, {r("quantile_disc(mbps, 25 / 101.0)", 2)} AS q25,
  {r("quantile_disc(mbps, 50 / 101.0)", 2)} AS q50, {r("quantile_disc(mbps, 75 / 101.0)", 2)} AS q75,
  {r("quantile_disc(mbps, 90 / 101.0)", 2)} AS q90, {r("max(mbps)", 2)} AS max,
  {_share("mbps < 1")} AS under_1, {_between(1, 3)} AS _1_3, {_between(3, 10)} AS _3_10,
  {_between(10, 30)} AS _10_30, {_between(30, 100)} AS _30_100, {_between(100, 300)} AS _100_300,
  {_share("mbps > 300")} AS over_300, count(*) FILTER (WHERE MinRTT > 50) AS far,
  {r("exp(avg(CASE WHEN MinRTT > 50 AND mbps > 0 THEN ln(mbps) END))")} AS "logMeanFarMbps"
FROM samples GROUP BY ALL"""

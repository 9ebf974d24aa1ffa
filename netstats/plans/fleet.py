"""Fleet health: how the servers' results look to a steady panel of clients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstats.functions.fingerprint import fingerprint
from netstats.functions.numbers import share, steady_round
from netstats.limits import DEFAULT, Limits
from netstats.operators.clean import between_dates
from netstats.operators.numbering import number
from netstats.operators.quantiles import Quantile, selected_quantiles, ranked_value, with_ranks
from netstats.operators.skew import join_null_safe

# Addresses of the platform's own monitoring clients, the metadata
# names clients report, and the shape of a test ID that carries a version.
MONITORING = (
    "45.56.98.222",
    "35.192.37.249",
    "35.225.75.192",
    "23.228.128.99",
    "2600:3c03::f03c:91ff:fe33:819",
    "2605:a601:f1ff:fffe::99",
)
METADATA = {
    "Name": "client_name",
    "OS": "client_os",
    "Arch": "client_arch",
    "Library": "client_library",
    "Version": "client_version",
    "LibraryVersion": "client_library_version",
}
VERSION = "(ndt-?.*)-.*"
# Window scale of clients that stand for many endpoints; they may give two samples.
SHARED_SCALE = 0x78

_CLIENT = [
    "ClientIP", "client.Name", "client.OS", "client.Version", "client.Arch", "client.Library",
    "client.LibraryVersion", "firstWScale", "NDTVersion", "isDownload",
]
GROUPS = {
    "machine": ["date", "server.Site", "server.Machine", *_CLIENT],
    "site": ["date", "server.Site", *_CLIENT],
    "metro": ["date", "server.Metro", *_CLIENT],
}


def _either(field: str) -> Column:
    """A raw field of whichever direction the test has."""
    return F.coalesce(F.col(f"raw.Download.{field}"), F.col(f"raw.Upload.{field}"))


def _hex2(number: Column, upper: bool) -> Column:
    """At least two hex digits; a negative number keeps its sign."""
    digits = F.hex(F.abs(number))
    digits = digits if upper else F.lower(digits)
    padded = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.when(number < 0, F.concat(F.lit("-"), digits)).otherwise(padded)


def normalise(tests: DataFrame, monitoring: Sequence[str] = MONITORING) -> DataFrame:
    """One row per test with the client's and the server's details in place."""
    metadata = _either("ClientMetadata")

    def reported(name: str) -> Column:
        return F.get(F.filter(metadata, lambda m: m["Name"] == name), F.lit(0))["Value"]

    snapshots = _either("ServerMeasurements")
    first = F.get(snapshots, F.lit(0))["TCPInfo"]["wscale"]
    last = F.try_element_at(snapshots, F.lit(-1))
    client = F.struct(
        "client.*",
        F.col("raw.ClientIP").isin(*monitoring).alias("isMonitoring"),
        *[reported(name).alias(field) for field, name in METADATA.items()],
        F.coalesce(first, F.lit(-1)).alias("WScale"),
    )
    server = F.struct("server.*", F.left(F.col("server.Site"), F.lit(3)).alias("Metro"))
    rows = tests.select(
        "ID",
        "date",
        server.alias("server"),
        client.alias("client"),
        F.col("raw.ClientIP").alias("ClientIP"),
        first.alias("firstWScale"),
        F.array_size(snapshots).alias("snapshots"),
        last.alias("lastSnapshot"),
        (last["TCPInfo"]["ElapsedTime"] / 1000000).alias("elapsedTime"),
        F.col("raw.Download").isNotNull().alias("isDownload"),
        F.nullif(F.regexp_extract("ID", VERSION, 1), F.lit("")).alias("NDTVersion"),
        fingerprint(F.col("ID")).alias("fp"),
        "a",
    )
    identity = [F.coalesce(F.col("ClientIP"), F.lit("none"))] + [
        F.coalesce(F.col(f"client.{c}"), F.lit("none"))
        for c in ("Name", "OS", "Arch", "Version", "Library", "LibraryVersion")
    ]
    text = F.concat_ws("_", *identity, _hex2(F.col("client.WScale"), upper=False))
    return rows.withColumn("endpointHash", F.lpad(F.hex(fingerprint(text)), 16, " "))


def _flat(groups: dict[str, list[str]]) -> dict[str, list[str]]:
    return {name: [c.replace(".", "_") for c in keys] for name, keys in groups.items()}


def _with_flat_keys(rows: DataFrame) -> DataFrame:
    """Group columns that are struct fields, as columns of their own."""
    nested = {c for keys in GROUPS.values() for c in keys if "." in c}
    return rows.withColumns({c.replace(".", "_"): F.col(c) for c in sorted(nested)})


def numbered(
    rows: DataFrame, limits: Limits = DEFAULT, rows_at_most: int | None = None
) -> DataFrame:
    """Sample numbers and counts per client on a machine, at a site and in a metro."""
    wide = _with_flat_keys(rows)
    out = number(
        wide, _flat(GROUPS), ["date", "ClientIP"], "snapshots", limits, rows_at_most
    )
    return out.select(
        *rows.columns, *[f"{name}{what}" for name in GROUPS for what in ("Sample", "Count")]
    )


def metro_frequency(rows: DataFrame) -> DataFrame:
    """Tests per day that an endpoint makes in a metro, per direction.

    The tests are counted per endpoint, the days per metro over all endpoints.
    """
    keyed = rows.select("date", F.col("server.Metro").alias("Metro"), "endpointHash", "isDownload")
    daily = keyed.groupBy("Metro", "endpointHash", "isDownload", "date").agg(F.count(F.lit(1)).alias("n"))
    tests = daily.groupBy("Metro", "endpointHash", "isDownload").agg(F.sum("n").alias("tests"))
    # Asking for `n` here too makes both sides the same up to the shuffle, which then runs once.
    day = F.when(F.col("n") > 0, F.col("date"))
    days = daily.groupBy("Metro", "isDownload").agg(F.count_distinct(day).alias("days"))
    return join_null_safe(tests, days, ["Metro", "isDownload"]).select(
        "Metro", "endpointHash", "isDownload", (F.col("tests") / F.col("days")).alias("metroFrequency")
    )


def panel(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the date range without the platform's own monitoring."""
    return between_dates(rows, start, end).where(~F.col("client.isMonitoring"))


def rated(rows: DataFrame) -> DataFrame:
    """Panel rows with the test rate of their endpoint."""
    keyed = rows.withColumn("Metro", F.col("server.Metro"))
    on = ["Metro", "endpointHash", "isDownload"]
    return join_null_safe(keyed, metro_frequency(rows), on).drop("Metro")


def first_samples(rows: DataFrame) -> DataFrame:
    """The first download of each client on each machine and day, or the first two.

    Only two rows of a group are ever wanted, so Spark drops the rest of it before
    the shuffle and a busy client costs no more than any other.
    """
    flat = _with_flat_keys(rows.where(F.col("isDownload")))
    order = Window.partitionBy(*_flat(GROUPS)["machine"]).orderBy(F.col("snapshots").desc(), "fp")
    return (
        flat.withColumn("machineSample", F.row_number().over(order))
        .where(F.col("machineSample") <= 2)
        .where((F.col("machineSample") == 1) | (F.col("client.WScale") == SHARED_SCALE))
        .select(*rows.columns)
    )


KEYS = [
    "test_date", "countryName", "ASName", "metro", "site", "machine", "clientName", "clientOS",
    "clientIsHot", "clientWScale", "NDTVersion", "complete", "slow",
]
QUANTILES = {
    "medianMinRTT": Quantile("MinRTT", 50, 101),
    "q10": Quantile("mbps", 10, 101),
    "q25": Quantile("mbps", 25, 101),
    "q50": Quantile("mbps", 50, 101),
    "q75": Quantile("mbps", 75, 101),
    "q90": Quantile("mbps", 90, 101),
}
DIGITS = {"mbps": 2, "MinRTT": 3}


def _sample_columns(rows: DataFrame) -> DataFrame:
    seconds = F.col("elapsedTime")
    return rows.select(
        F.col("date").alias("test_date"),
        F.col("client.Geo.CountryName").alias("countryName"),
        F.col("client.Network.ASName").alias("ASName"),
        F.col("server.Metro").alias("metro"),
        F.col("server.Site").alias("site"),
        F.col("server.Machine").alias("machine"),
        F.col("client.Name").alias("clientName"),
        F.col("client.OS").alias("clientOS"),
        (F.col("metroFrequency") > 9).alias("clientIsHot"),
        _hex2(F.col("client.WScale"), upper=True).alias("clientWScale"),
        "NDTVersion",
        seconds.between(7, 10.1).alias("complete"),
        (F.col("a.MeanThroughputMbps") <= 0.1).alias("slow"),
        "endpointHash",
        F.col("a.UUID").alias("uuid"),
        F.col("a.MeanThroughputMbps").alias("mbps"),
        F.col("a.MinRTT").alias("MinRTT"),
        F.col("a.LossRate").alias("LossRate"),
    )


def _correlation(x: str, y: str, where: str) -> str:
    """Pearson correlation: NULL below two pairs, NaN where one side does not vary.

    The built-in aggregate divides by zero in the second case, which is an error in
    ANSI mode.
    """
    x, y = (f"CASE WHEN {where} THEN {v} END" for v in (x, y))
    ratio = f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y}))"
    known = f"coalesce({steady_round(ratio, 3)}, double('NaN'))"
    return f"CASE WHEN count_if({where}) >= 2 THEN {known} END"


def _aggregates() -> list[Column]:
    tests = "count(uuid)"
    texts = {
        "clients": "count(DISTINCT endpointHash)",
        "endpoints": "count(DISTINCT endpointHash)",
        "tests": tests,
        "log_mean_speed": steady_round("exp(avg(CASE WHEN mbps > 0 THEN ln(mbps) END))", 2),
        "rttUnder10msec": share("MinRTT < 10", tests),
        "meanMinRTT": steady_round("avg(CASE WHEN MinRTT < 10000 THEN MinRTT END)", 3),
        # Here a round-trip time of zero or less counts as a logarithm of 0.
        "logMeanMinRTT": steady_round(
            "exp(avg(CASE WHEN MinRTT > 0 THEN ln(MinRTT) ELSE 0 END))", 3
        ),
        "AvgLossRate": "avg(LossRate)",
        "pearson": _correlation("-ln(MinRTT)", "ln(mbps)", "MinRTT > 0 AND mbps > 0"),
        "max": "round(max(mbps), 2)",
        "under_1": share("mbps < 1", tests),
        "_1_3": share("mbps BETWEEN 1 AND 3", tests),
        "_3_10": share("mbps BETWEEN 3 AND 10", tests),
        "_10_30": share("mbps BETWEEN 10 AND 30", tests),
        "_30_100": share("mbps BETWEEN 30 AND 100", tests),
        "_100_300": share("mbps BETWEEN 100 AND 300", tests),
        "over_300": share("mbps > 300", tests),
        "far": "count_if(MinRTT > 50)",
        "logMeanFarMbps": steady_round(
            "exp(avg(CASE WHEN MinRTT > 50 AND mbps > 0 THEN ln(mbps) END))", 3
        ),
    }
    return [F.expr(f"{text} AS `{name}`") for name, text in texts.items()]


OUTPUT = [
    "test_date", "compute_date", *KEYS[1:10], *KEYS[10:], "clients", "endpoints", "tests",
    "log_mean_speed", "rttUnder10msec", "medianMinRTT", "meanMinRTT", "logMeanMinRTT",
    "AvgLossRate", "pearson", "q10", "q25", "q50", "q75", "q90", "max", "under_1", "_1_3",
    "_3_10", "_10_30", "_30_100", "_100_300", "over_300", "far", "logMeanFarMbps",
]


def largest_panel(rows: DataFrame) -> int:
    """Rows of the busiest machine on its busiest day: no output group has more."""
    sizes = rows.groupBy("date", "server.Site", "server.Machine").count()
    return sizes.agg(F.max("count")).first()[0] or 0


def fleet_health(
    tests: DataFrame,
    start: str,
    end: str,
    compute_date: Column | None = None,
    monitoring: Sequence[str] = MONITORING,
    limits: Limits = DEFAULT,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Daily health per machine and kind of client."""
    rows = panel(normalise(tests, monitoring), start, end)
    if rows_at_most is None or rows_at_most > limits.samples_per_group:
        rows_at_most = largest_panel(rows)
    on = ["Metro", "endpointHash", "isDownload"]
    sampled = first_samples(rows).withColumn("Metro", F.col("server.Metro"))
    samples = _sample_columns(join_null_safe(sampled, metro_frequency(rows), on))
    if rows_at_most > limits.samples_per_group:
        stats = join_null_safe(
            samples.groupBy(*KEYS).agg(*_aggregates()),
            selected_quantiles(samples, KEYS, QUANTILES, DIGITS),
            KEYS,
            "left",
        )
    else:
        ranked = with_ranks(samples, KEYS, ["mbps", "MinRTT"])
        exact = [F.expr(f"{ranked_value(q)} AS {name}") for name, q in QUANTILES.items()]
        stats = ranked.groupBy(*KEYS).agg(*_aggregates(), *exact)
    return (
        stats.withColumns({n: F.round(n, DIGITS[q.series]) for n, q in QUANTILES.items()})
        .withColumn("compute_date", F.current_date() if compute_date is None else compute_date)
        .select(*OUTPUT)
    )

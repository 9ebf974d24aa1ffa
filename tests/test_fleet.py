from __future__ import annotations

import math
import re
from datetime import date, datetime

from helpers import GEO, as_set
from pyspark.sql import functions as F

from netstats.limits import Limits
from netstats.plans import fleet
from netstats.schema import FLEET

DAY = date(2024, 3, 1)


def raw(id, mbps=5.0, rtt=5.0, ip="10.0.0.1", scale=7, snapshots=2, download=True, name="n",
        day=DAY, machine="m1", elapsed=8_000_000, uuid="u"):
    side = {
        "ClientMetadata": [{"Name": "client_name", "Value": name}],
        "ServerMeasurements": [
            {"TCPInfo": {"wscale": scale, "ElapsedTime": elapsed, "Retransmits": 0}}
        ] * snapshots,
    }
    network = {"CIDR": None, "ASNumber": 1, "ASName": "AS1"}
    return (
        id, day, {"Site": "lga01", "Machine": machine}, {"Geo": GEO, "Network": network},
        {"ClientIP": ip, "Download": side if download else None, "Upload": None if download else side},
        {"UUID": uuid, "TestTime": datetime(2024, 3, 1), "CongestionControl": "bbr",
         "MeanThroughputMbps": mbps, "MinRTT": rtt, "LossRate": 0.0},
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, FLEET)


def health(spark, rows, **options):
    return fleet.fleet_health(
        frame(spark, rows), "2024-03-01", "2024-03-31", F.lit(DAY), **options
    ).collect()


def test_normalised_rows(spark):
    rows = fleet.normalise(
        frame(
            spark,
            [raw("ndt-x-1"), raw("ndt7-canary-9-2", download=False, snapshots=0), raw("plain", scale=-5),
             raw("ndt-y-4", ip="45.56.98.222", scale=300)],
        )
    ).collect()
    assert [r.NDTVersion for r in rows] == ["ndt-x", "ndt7-canary-9", None, "ndt-y"]
    assert [r.isDownload for r in rows] == [True, False, True, True]
    assert [r.client.WScale for r in rows] == [7, -1, -5, 300]
    assert [r.elapsedTime for r in rows] == [8.0, None, 8.0, 8.0]
    assert [r.client.isMonitoring for r in rows] == [False, False, False, True]
    assert rows[0].server.Metro == "lga" and rows[0].client.Name == "n" and rows[0].client.OS is None
    assert all(len(r.endpointHash) == 16 and r.endpointHash[0] == " " for r in rows)
    assert len({r.endpointHash for r in rows}) == 4


def test_hot_clients_get_the_same_numbers(spark):
    rows = frame(
        spark,
        [raw(f"ndt-a-{i}", ip="hot" if i % 2 else f"ip{i % 5}", snapshots=i % 4,
             machine=f"m{i % 2}", name=None if i % 3 else "n") for i in range(300)],
    )
    normal = fleet.normalise(rows)
    columns = ["ID", *[f"{g}{w}" for g in fleet.GROUPS for w in ("Sample", "Count")]]
    windows = as_set(fleet.numbered(normal).select(columns))
    assert as_set(fleet.numbered(normal, Limits(tests_per_group=20)).select(columns)) == windows


def test_slices_of_all_groups_come_from_one_count(spark):
    """Rows are read for the ordinary and the hot clients and once for the sizes of each group, not twice as often with every group."""
    normal = fleet.normalise(frame(spark, [raw(f"ndt-a-{i}") for i in range(9)]))
    numbered = fleet.numbered(normal, Limits(tests_per_group=2)).select("ID", "metroSample")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"InMemoryTableScan", plan)) <= 5
    assert sorted(r.metroSample for r in numbered.collect()) == list(range(1, 10))


def test_longer_tests_come_first(spark):
    rows = [raw("a", snapshots=0), raw("b", snapshots=3), raw("c", snapshots=3)]
    found = {r.ID: r.machineSample for r in fleet.numbered(fleet.normalise(frame(spark, rows))).collect()}
    # The test without snapshots has no window scale either, so it is a group of its own.
    assert found["a"] == 1 and {found["b"], found["c"]} == {1, 2}


def test_rate_counts_all_days_of_the_metro(spark):
    rows = [raw(f"ndt-a-{i}") for i in range(6)]
    rows += [raw("ndt-a-9", ip="other", day=date(2024, 3, 2))]
    rows += [raw("ndt-a-10", ip="45.56.98.222", day=date(2024, 3, 3))]
    normal = fleet.panel(fleet.normalise(frame(spark, rows)), "2024-03-01", "2024-03-31")
    rates = {r.ID: r.metroFrequency for r in fleet.rated(normal).collect()}
    assert rates == {**{f"ndt-a-{i}": 3.0 for i in range(6)}, "ndt-a-9": 0.5}


def test_samples_per_machine(spark):
    rows = [raw(f"ndt-a-{i}") for i in range(5)] + [raw(f"ndt-b-{i}", ip="s", scale=0x78) for i in range(5)]
    rows += [raw("ndt-c-1", ip="z", download=False)]
    found = {r.clientWScale: r.tests for r in health(spark, rows)}
    assert found == {"07": 1, "78": 2}


def test_shared_edges_and_guards(spark):
    values = [(3.0, 0.0), (0.5, 20000.0), (10.0, 60.0), (400.0, 5.0)]
    rows = [raw(f"ndt-a-{i}", mbps=m, rtt=t, ip=f"ip{i}") for i, (m, t) in enumerate(values)]
    (row,) = health(spark, rows)
    assert row._1_3 == 0.25 and row._3_10 == 0.5 and row._10_30 == 0.25 and row.over_300 == 0.25
    assert row.under_1 == 0.25 and row.far == 2 and row.clients == row.endpoints == 4
    assert row.meanMinRTT == round((0 + 60 + 5) / 3, 3)
    assert row.logMeanMinRTT == round(math.exp((math.log(20000) + math.log(60) + math.log(5)) / 4), 3)
    assert row.q50 == 3.0 and row["max"] == 400.0 and row.test_date == DAY and row.compute_date == DAY


def test_correlation_without_variation(spark):
    rows = [raw(f"ndt-a-{i}", mbps=2.0, rtt=3.0 + i, ip=f"ip{i}") for i in range(3)]
    (row,) = health(spark, rows)
    assert math.isnan(row.pearson)
    (row,) = health(spark, rows[:1])
    assert row.pearson is None


def test_spread_health_is_the_same(spark):
    rows = [
        raw(f"ndt-a-{i}", mbps=i % 17 + 0.3, rtt=float(i % 9), ip=f"ip{i}", name=None if i % 2 else "n",
            uuid="u" if i % 5 else None)
        for i in range(60)
    ]
    spread = health(spark, rows, limits=Limits(samples_per_group=5))
    assert sorted(map(repr, health(spark, rows))) == sorted(map(repr, spread))


def test_only_two_rows_of_a_client_are_shuffled(spark):
    normal = fleet.normalise(frame(spark, [raw("ndt-a-1")]))
    plan = fleet.first_samples(normal)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan

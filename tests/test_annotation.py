from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from netstats.plans import annotation
from netstats.schema import ANNOTATION_INDEX, ANNOTATIONS, TCPINFO, TRACEROUTE
from netstats.sources.files import write_files

GEO = {
    "ContinentCode": "OC", "CountryCode": "ZZ", "CountryName": "Nowhere", "Region": "N1",
    "Subdivision1ISOCode": "N1", "Subdivision1Name": "North", "Subdivision2ISOCode": "Q",
    "Subdivision2Name": "Quay", "City": "Old Quay", "PostalCode": "Q-17",
    "Latitude": -4.0, "Longitude": 12.25, "AccuracyRadiusKm": 30,
}
NETWORK = {"CIDR": "192.0.2.0/24", "ASNumber": 64511, "ASName": "Example \":7.0, net"}
EMPTY = {**{k: ("" if isinstance(v, str) else type(v)(0)) for k, v in GEO.items()}, "City": "X"}


def connection(uuid, time, site="abc01", geo=GEO, part=None):
    server = {"Site": site, "Machine": "node1", "Geo": geo, "Network": NETWORK}
    client = {"Geo": EMPTY, "Network": {"CIDR": "", "ASNumber": 0, "ASName": ""}}
    return (uuid, time, server, client, part or time.date())


def missing(spark, rows, known=(), start="2020-01-01", end="2020-01-31"):
    return annotation.missing_connections(
        spark.createDataFrame(rows, TCPINFO),
        spark.createDataFrame(list(known), ANNOTATION_INDEX),
        start,
        end,
    )


def test_missing_connections(spark):
    t = datetime(2020, 1, 5, 10, 0, 1, 500000)
    rows = [
        connection("a", t),
        connection("a", t.replace(hour=9), site="first"),
        connection("a", datetime(2020, 1, 6, 1)),
        connection("known", t),
        connection("other-day", t),
        connection("", t),
        connection(None, t),
        connection("no-site", t, site=""),
        connection("no-geo", t, geo=None),
        connection("late", t, part=date(2020, 1, 7)),
        connection("near", t, part=date(2020, 1, 6)),
        connection("outside", datetime(2020, 2, 5)),
    ]
    known = [("known", t.date()), ("known", t.date()), ("other-day", date(2020, 1, 6))]
    found = missing(spark, rows, known).collect()
    assert {(r.UUID, r.year_month_day) for r in found} == {
        ("a", "2020/01/05"), ("a", "2020/01/06"), ("other-day", "2020/01/05"), ("near", "2020/01/05"),
    }
    first = next(r for r in found if r.UUID == "a" and r.year_month_day == "2020/01/05")
    assert first.Server.Site == "first" and first.Timestamp.hour == 9


def test_connection_files_leave_out_empty_fields(spark, tmp_path):
    rows = [connection("u1", datetime(2020, 1, 5, 10, 0, 1, 500000))]
    files = annotation.connection_files(missing(spark, rows))
    row = files.first()
    assert row.path == "2020/01/05/u1.json"
    content = json.loads(row.content)
    assert content["Timestamp"] == "2020-01-05T10:00:01.5Z"
    assert content["Client"] == {"Geo": {"City": "X"}, "Network": {}}
    assert content["Server"]["Geo"] == GEO
    write_files(files, str(tmp_path))
    assert (tmp_path / row.path).read_text() == row.content


def hop(id, time, annotations=True, ip="10.0.0.1"):
    record = {"Geo": GEO, "Network": NETWORK} if annotations else None
    return {"Source": {"IP": ip, "hopannotation1": {"ID": id, "Timestamp": time, "Annotations": record}}}


def test_missing_hops(spark):
    t = datetime(2021, 3, 21, 11, 9)
    late = datetime(2021, 3, 22, 0, 1)
    traces = [
        (t, t.date(), [hop("2021_h1_x", t, ip="10.0.0.2"), hop("2021_h1_x", t.replace(hour=10))]),
        (t, t.date(), [hop("plain", t), hop("", t), hop(None, t), hop("bare", t, False)]),
        (t, t.date(), [hop("seen_a_b", t), hop("seen-long-ago", t)]),
        (datetime(2021, 3, 21, 23, 59), t.date(), [hop("2021_mid_y", late)]),
        (late, late.date(), [hop("2021_mid_y", late)]),
        (t, None, [hop("unfiled", t)]),
        (t, t.date(), []),
    ]
    known = [("seen_a_b", date(2021, 3, 22)), ("seen-long-ago", date(2021, 3, 1))]
    found = annotation.missing_hops(
        spark.createDataFrame(traces, TRACEROUTE),
        spark.createDataFrame(known, ANNOTATION_INDEX),
        annotation.HOP_FIRST,
        annotation.HOP_LAST,
    )
    rows = {r.ID: r for r in found.collect()}
    assert found.count() == 4
    assert set(rows) == {"2021_h1_x", "plain", "seen-long-ago", "2021_mid_y"}
    assert rows["2021_h1_x"].Timestamp == "2021-03-21T10:09:00Z"
    assert rows["2021_h1_x"].Hostname == "h1" and rows["plain"].Hostname is None
    assert rows["2021_mid_y"].Date == "2021/03/22"
    paths = {r.path for r in annotation.hop_files(found).collect()}
    assert "2021/03/21/20210321T000000Z_h1_10.0.0.1.json" in paths


def test_hop_file_content(spark):
    schema = f"ID STRING, Timestamp STRING, Annotations {ANNOTATIONS}, Date STRING, FilenameTimestamp STRING, Hostname STRING, IP STRING"
    place = {**dict.fromkeys(GEO), "City": "Old Quay", "Latitude": -4.0, "Longitude": 12.25, "AccuracyRadiusKm": 30}
    row = ("hop-7", "2021-05-02T03:04:05Z", {"Geo": place, "Network": NETWORK}, "d", "f", "h", "i")
    content = annotation.hop_files(spark.createDataFrame([row], schema)).first().content
    assert content == (
        '{"ID":"hop-7","Timestamp":"2021-05-02T03:04:05Z","Annotations":{"Geo":{"City":"Old Quay","Latitude":-4,'
        '"Longitude":12.25,"AccuracyRadiusKm":30},"Network":{"CIDR":"192.0.2.0/24","ASNumber":64511,'
        '"ASName":"Example \\":7.0, net"}}}'
    )


def test_a_missing_client_is_an_empty_object(spark):
    uuid, time, server, _, day = connection("u1", datetime(2020, 1, 5))
    files = annotation.connection_files(missing(spark, [(uuid, time, server, None, day)]))
    content = json.loads(files.first().content)
    assert content["Client"] == {} and content["Server"]["Site"] == "abc01"


def test_days_to_backfill(spark):
    days = [datetime(2020, 3, d, 5) for d in (9, 10, 10, 11)]
    frame = spark.createDataFrame([(d,) for d in days], "TestTime TIMESTAMP")
    found = annotation.days_to_backfill(frame, before=annotation.TCPINFO_BEFORE)
    assert [r.date.day for r in found.collect()] == [9, 10]
    bounded = annotation.days_to_backfill(frame, "2020-03-10", "2020-03-11")
    assert [r.date.day for r in bounded.select(F.col("date")).collect()] == [10, 11]

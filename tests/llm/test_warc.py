"""ARC and WARC files, written, converted and read back."""

from __future__ import annotations

import gzip
import hashlib

import pytest
from netstats.llm import warc
from fixtures import rows_of

LONG = "<html>" + "a long page " * 20 + "</html>"


def plain(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None) if len(payload) >= 100 else page
        revisit = first is not None and page != first
        digest = hashlib.sha256(payload).hexdigest()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_pages_come_back(spark):
    rows = [
        (5, "http://a/", LONG), (3, "http://b/ with space\n", LONG), (9, None, LONG), (1, "", None), (2, "http://c/", ""),
        (4, "http://d/", "short"), (6, "http://e/", "short"), (7, "http://f/", "WARC/1.0\r\n\r\nx\r\n\r\n" * 30), (8, "http://g/", "é🙂\x00\n" * 50),
        (10, "http://h/", "http://x 0.0.0.0 20000101000000 text/html 5\nhello\n" * 9), (None, "http://i/", "no number " * 30),
        (None, "http://j/", LONG), (11, "http://k/", "big " * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = rows_of(warc.archived(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert found == plain(rows)
    assert warc.archived(pages.limit(0)).count() == 0


def test_repeated_rows_are_revisits_but_for_one(spark):
    pages = spark.createDataFrame([(1, "u", LONG)] * 3, "page_id long, url string, html string")
    kinds = [r.record_type for r in warc.archived(pages).collect()]
    assert sorted(kinds) == ["response", "revisit", "revisit"]


HTTP = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n"


def arc(version, *records):
    fields = warc.ARC_DEFINITION[version].encode()
    block = version + b" 0 who\n" + fields + b"\n"
    more = b"200 - - 0 x.arc " if version == b"2" else b""
    out = b"filedesc://x.arc 0.0.0.0 19990101000000 text/plain " + more + b"%d\n" % len(block) + block + b"\n"
    for url, mime, body in records:
        out += url + b" 1.2.3.4 19990203040506 " + mime + b" " + more + b"%d\n" % len(body) + body + b"\n"
    return out


def test_header_lines_of_both_versions():
    body = HTTP + b"payload\n\nwith lines\n"
    for version in (b"1", b"2"):
        content = arc(version, (b"http://a/b c", b"text/html", body), (b"dns:a", b"text/dns", b"1.2.3.4"), (b"http://e/", b"text/html", b""))
        for given in (content, gzip.compress(content)):
            rows = list(warc.parse_arc("f", given))
            assert [r[2:] for r in rows] == [
                ("http://a/b c", "1.2.3.4", "19990203040506", "text/html", HTTP, b"payload\n\nwith lines\n", None),
                ("dns:a", "1.2.3.4", "19990203040506", "text/dns", b"", b"1.2.3.4", None),
                ("http://e/", "1.2.3.4", "19990203040506", "text/html", b"", b"", None),
            ]


def test_broken_archives():
    content = arc(b"1", (b"http://a/", b"text/html", b"x" * 50))
    assert list(warc.parse_arc("f", content[:-20]))[-1][-1] == "truncated"
    assert list(warc.parse_arc("f", content + b"not a header\n"))[-1][-1] == "header"
    assert list(warc.parse_arc("f", gzip.compress(content)[:-12]))[-1][-1] is not None
    assert list(warc.parse_arc("f", b"")) == []
    assert list(warc.parse_warc("f", b"nonsense\r\n"))[-1][-1] == "version line"


def test_synthesised_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    body = HTTP + b"\xff\xfe raw bytes" * 10
    records = [(b"http://a/", b"text/html", body), (b"http://b/", b"text/html", body), (b"dns:a", b"text/dns", b"1.2.3.4")]
    (tmp_path / "in" / "x.arc").write_bytes(arc(b"2", *records))
    for out in ("one", "two"):
        warc.arc_to_warc(warc.read_arc(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/{out}")
    first, again = (warc.read_warc(spark, f"file://{tmp_path}/{out}").collect() for out in ("one", "two"))
    assert sorted(r.record_id for r in first) == sorted(r.record_id for r in again)
    kinds = {r.uri: r for r in first}
    full, other = sorted((kinds["http://a/"], kinds["http://b/"]), key=lambda r: r.type)
    assert (full.type, other.type, kinds["dns:a"].type) == ("response", "revisit", "resource")
    assert other.refers_to == full.record_id and full.date == "1999-02-03T04:05:06Z"
    assert {r.error for r in first} == {None}
    assert full.payload_digest == other.payload_digest == hashlib.sha256(body[len(HTTP) :]).hexdigest()
    assert full.payload_bytes == other.payload_bytes == len(body) - len(HTTP)


def test_a_page_may_be_named_like_a_version_block(spark):
    rows = [(1, "http://a/", LONG), (2, "filedesc://x", "a page"), (3, "filedesc:y", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    assert rows_of(warc.archived(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == plain(rows)


def test_a_broken_archive_fails(spark, monkeypatch):
    def broken(pages, path):
        content = arc(b"1", (b"http://a/", b"text/html", b"x" * 50), (b"http://b/", b"text/html", b"y" * 50))[:-20]
        spark.createDataFrame([(content.decode(),)], "value string").write.option("lineSep", "\n").text(path)

    monkeypatch.setattr(warc, "write_arc", broken)
    with pytest.raises(Exception, match="archive not read: truncated"):
        warc.archived(spark.createDataFrame([(1, "u", LONG)], "page_id long, url string, html string")).collect()

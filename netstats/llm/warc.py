"""Legacy ARC archives converted to WARC, and both read back."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netstats.llm.shared import shared_folder

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 100
#: Bytes of records that a task hands on at a time.
BATCH_BYTES = 8 << 20
#: The fields of an ARC header line, by version of the file.
ARC_FIELDS = {
    b"1": ["url", "ip", "date", "mime", "length"],
    b"2": ["url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"],
}
ARC_DEFINITION = {
    b"1": "URL IP-address Archive-date Content-type Archive-length",
    b"2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_SCHEMA = "file string, at long, url string, ip string, date string, mime string, head binary, payload binary, error string"
WARC_SCHEMA = (
    "type string, record_id string, refers_to string, refers_to_page string, uri string, date string, "
    "head string, payload_bytes long, payload_digest string, error string"
)


def _first_of_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def write_arc(pages: DataFrame, path: str, captured: str = "20000101000000") -> None:
    """Writes page_id, url and html as ARC files, gzipped, of version 1 and version 2 by turns.

    Each file starts with its version block. A page is an HTTP response that names the page in X-Page-Id (not, if
    null). Null html is an empty payload; a null or empty url is `unknown:`; white space and control characters in
    a url are written as %20, since a header line is divided by spaces.
    """
    second = F.spark_partition_id() % 2 == 1
    name = F.concat(F.lit("part-"), F.spark_partition_id())
    html = F.coalesce("html", F.lit(""))
    body = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html),
        F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")),
        F.lit("\r\n\r\n"),
        html,
    )
    url = F.regexp_replace(F.coalesce(F.nullif("url", F.lit("")), F.lit("unknown:")), r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(url.alias("url"), body.alias("body"))

    def line(url: Column, mime: str, status: str, length: Column) -> Column:
        start = F.concat(url, F.lit(f" 0.0.0.0 {captured} {mime} "))
        more = F.when(second, F.concat(F.lit(f"{status} - - 0 "), name, F.lit(".arc "))).otherwise("")
        return F.concat(start, more, length.cast("string"), F.lit("\n"))

    block = F.when(second, F.lit(f"2 0 netstats\n{ARC_DEFINITION[b'2']}\n")).otherwise(F.lit(f"1 0 netstats\n{ARC_DEFINITION[b'1']}\n"))
    about = F.concat(line(F.concat(F.lit("filedesc://"), name, F.lit(".arc")), "text/plain", "200", F.octet_length(block)), block, F.lit("\n"))
    record = F.concat(line(F.col("url"), "text/html", "200", F.octet_length("body")), F.col("body"))
    value = F.concat(F.when(_first_of_task(), about).otherwise(""), record)
    rows.select(value.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _opened(path: str, content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return gzip.open(raw) if content[:2] == b"\x1f\x8b" else raw


def parse_arc(path: str, content: bytes) -> Iterator[tuple]:
    """Rows of ARC_SCHEMA: every record of one file but the version block at its start.

    The version block tells the fields of all header lines. Fields are taken from the right, so that a url may have
    spaces, and the declared length alone says where a record ends. Where a file breaks off or a header line cannot be
    read, the last row has `error`.
    """
    stream, fields, at = _opened(path, content), ARC_FIELDS[b"1"], 0
    try:
        while line := stream.readline():
            start, at = at, at + len(line)
            if not line.strip():
                continue
            parts = line.rstrip(b"\r\n").rsplit(b" ", len(fields) - 1)
            about = start == 0 and line.startswith(b"filedesc:")
            if about:
                parts = line.split()
            if len(parts) < 5 or not parts[-1].isdigit():
                yield path, start, None, None, None, None, None, None, "header"
                return
            body = stream.read(int(parts[-1]))
            at += len(body)
            short = "truncated" if len(body) < int(parts[-1]) else None
            if about:
                fields = ARC_FIELDS.get(body[:1], fields)
                continue
            if len(parts) != len(fields):
                yield path, start, None, None, None, None, None, None, "header"
                return
            found = dict(zip(fields, (x.decode("utf-8", "replace") for x in parts), strict=True))
            cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") and b"\r\n\r\n" in body else 0
            yield path, start, found["url"], found["ip"], found["date"], found["mime"], body[:cut], body[cut:], short
    except (EOFError, OSError) as error:
        yield path, at, None, None, None, None, None, None, type(error).__name__


def _headers(block: bytes) -> dict[str, str]:
    lines = re.sub(rb"\r?\n[ \t]+", b" ", block).decode("utf-8", "replace").splitlines()
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def parse_warc(path: str, content: bytes) -> Iterator[tuple]:
    """Rows of WARC_SCHEMA: every response, resource and revisit record of one file.

    Length and digest of a full payload are taken from the bytes, those of a revisit from its header. A file that breaks
    off, or a digest that does not fit the payload, shows in `error`.
    """
    stream = _opened(path, content)
    try:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                yield (*[None] * 9, "version line")
                return
            block = b""
            while (line := stream.readline()).strip():
                block += line
            head = _headers(block)
            length = int(head.get("content-length", "0"))
            body = stream.read(length)
            kind = head.get("warc-type")
            if kind not in ("response", "resource", "revisit"):
                continue
            error = "truncated" if len(body) < length else None
            cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") and b"\r\n\r\n" in body else 0
            said = head.get("warc-payload-digest", "").partition(":")[2]
            if kind == "revisit":
                size, digest = int(head.get("x-payload-length", "0")), said
            else:
                size, digest = len(body) - cut, hashlib.sha256(memoryview(body)[cut:]).hexdigest()
                error = error or ("digest" if said and said != digest else None)
            yield (
                kind, head.get("warc-record-id"), head.get("warc-refers-to"), head.get("x-refers-to-page-id"),
                head.get("warc-target-uri"), head.get("warc-date"), body[:cut].decode("utf-8", "replace"), size, digest, error,
            )
    except (EOFError, OSError, ValueError) as error:
        yield (*[None] * 9, type(error).__name__)


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Files are read whole, compressed as they are, and parsed as a stream, record by record."""
    parse, schema = (parse_arc, ARC_SCHEMA) if kind == "arc" else (parse_warc, WARC_SCHEMA)
    sample = spark.createDataFrame([], schema).schema
    types = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    names, kinds = [f.name for f in sample], [types[f.dataType.simpleString()] for f in sample]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for name, content in zip(files.column(0), files.column(1), strict=True):
                for row in parse(name.as_py(), content.as_py()):
                    rows.append(row)
                    size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
                    if size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*[!_]*").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, sample)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all ARC files under `path`, plain or gzipped; any Hadoop path."""
    return _read(spark, path, "arc")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response, resource and revisit records of all WARC files under `path`, plain or gzipped; any Hadoop path."""
    return _read(spark, path, "warc")


def page_id(head: Column) -> Column:
    return F.nullif(F.regexp_extract(head.cast("string"), r"(?i)\r\nX-Page-Id: (\S+)", 1), F.lit(""))


def _uuid(*parts: Column) -> Column:
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("\n", *parts)), r"(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"))


def arc_to_warc(records: DataFrame, path: str) -> None:
    """Writes the records of `read_arc` as WARC files, gzipped.

    Identifiers are made from file and offset, so that a repeated task makes the same; dates, addresses and targets
    are those of the ARC header line; an HTTP response becomes a response, anything else a resource. Of
    records with equal payloads of REVISIT_BYTES or more, the one with the smallest page number (none after all others;
    then the smallest identifier) is written in full; the others become revisits that refer to it, hold the HTTP head
    and name the payload's length and digest. Records that could not be read are left out.

    First records are found by an aggregate that is combined before its shuffle, and met by a join whose large
    partitions adaptive execution splits.
    """
    number = page_id(F.col("head"))
    # The file's own name, not the folder: a copy of the archive gets the same identifiers.
    rows = records.where("error IS NULL").select(
        "*",
        _uuid(F.regexp_extract("file", r"part-\d+|[^/]+$", 0), F.col("at").cast("string")).alias("record_id"),
        number.alias("page"),
        F.sha2("payload", 256).alias("digest"),
    )
    order = F.struct(number.cast("decimal(38,0)").isNull().alias("none"), number.cast("decimal(38,0)").alias("n"), "page", F.col("record_id").alias("id"))
    firsts = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", F.col("first.id").alias("first_id"), F.col("first.page").alias("first_page"))
    )
    joined = rows.join(firsts, "digest", "left")
    again = F.coalesce(F.col("first_id") != F.col("record_id"), F.lit(False)) & (F.octet_length("payload") >= REVISIT_BYTES)
    http = F.octet_length("head") > 0
    kind = F.when(again, "revisit").when(http, "response").otherwise("resource")
    mime = F.when(http, "application/http; msgtype=response").otherwise(F.col("mime"))
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    date = F.regexp_replace(F.rpad("date", 14, "0"), r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    head = [
        field("WARC-Type", kind),
        field("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        field("WARC-Date", date),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Profile", F.when(again, PROFILE)),
        field("WARC-Refers-To", F.when(again, F.concat(F.lit("<"), F.col("first_id"), F.lit(">")))),
        field("X-Refers-To-Page-Id", F.when(again, F.col("first_page"))),
        field("X-Payload-Length", F.when(again, F.octet_length("payload").cast("string"))),
        field("Content-Type", mime),
        field("Content-Length", F.octet_length(block).cast("string")),
    ]
    about = "software: netstats\r\nformat: WARC File Format 1.0\r\n"
    info = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: "), date, F.lit("\r\nWARC-Record-ID: <"), _uuid(F.lit("info"), F.col("record_id")),
        F.lit(f">\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"),
    )
    value = F.concat(F.when(_first_of_task(), info).otherwise(""), F.lit("WARC/1.0\r\n"), *head, F.lit("\r\n"), block.cast("string"))
    joined.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def sound(records: DataFrame) -> DataFrame:
    """The records; the job fails at one that could not be read."""
    failed = F.raise_error(F.concat(F.lit("archive not read: "), F.col("error")))
    return records.withColumn("error", F.when(F.col("error").isNotNull(), failed.cast("string")))


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to for each row of `pages`, by way of archives.

    The pages are written as ARC files to the shared folder, converted to WARC files there, and read back. Null html is
    an empty payload. Repeated rows are repeated records, all but one of them revisits. A null page_id stays
    null and comes after all others. No rows give no rows. Other columns of `pages` are not archived.
    An archive that breaks off or cannot be read makes the job fail.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    kind = pages.schema["page_id"].dataType
    write_arc(pages, f"{folder}/arc")
    arc_to_warc(sound(read_arc(spark, f"{folder}/arc")), f"{folder}/warc")
    return sound(read_warc(spark, f"{folder}/warc")).where("error IS NULL").select(
        page_id(F.col("head")).cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_page").cast(kind).alias("refers_to"),
    )

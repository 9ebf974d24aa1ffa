"""Backfill of annotations that are missing from the annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The days each backfill covers, its file path, and the shape of a
# hop ID that carries a host name.
TCPINFO_BEFORE = "2020-03-11"
HOP_FIRST, HOP_LAST = "2019-03-29", "2021-09-08"
TCPINFO_PATH = "{year_month_day}/{UUID}.json"
HOP_PATH = "{Date}/{FilenameTimestamp}_{Hostname}_{IP}.json"
HOST_IN_ID = ".+_(.+)_.+"


def days_to_backfill(
    tests: DataFrame, first: str | None = None, last: str | None = None, before: str | None = None
) -> DataFrame:
    """Distinct test days within the bounds, in order."""
    day = F.to_date("TestTime")
    rows = tests.select(day.alias("date"))
    if first:
        rows = rows.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        rows = rows.where(F.col("date") <= F.lit(last).cast("date"))
    if before:
        rows = rows.where(F.col("date") < F.lit(before).cast("date"))
    return rows.distinct().orderBy("date")


def _in_days(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows tested within the range that were filed within a day of their test.

    The first condition only helps to prune partitions by `part_date`.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.to_date("TestTime")
    return (
        rows.where(F.col("part_date").between(F.date_sub(first, 1), F.date_add(last, 1)))
        .where(day.between(first, last))
        .where(F.abs(F.date_diff("part_date", day)) <= 1)
        .withColumn("day", day)
    )


def _index(annotated: DataFrame, start: str, end: str) -> DataFrame:
    """Annotated (id, date) pairs of the range and a day to each side, once each."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return (
        annotated.where(F.col("date").between(F.date_sub(first, 1), F.date_add(last, 1)))
        .select("id", "date")
        .distinct()
    )


def _slashed(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def missing_connections(
    tcpinfo: DataFrame, annotated: DataFrame, start: str, end: str
) -> DataFrame:
    """One record per (UUID, day) that has connection data but no annotation.

    A long-lived connection can have very many rows. They are reduced to one per day
    before the anti-join, which cannot change its outcome. All fields come from the
    earliest row.
    """
    usable = (
        (F.col("UUID") != "")
        & (F.col("ServerX.Site") != "")
        & F.col("ServerX.Geo").isNotNull()
    )
    first = F.min(F.struct("TestTime", "ServerX", "ClientX")).alias("first")
    per_day = _in_days(tcpinfo, start, end).where(usable).groupBy("UUID", "day").agg(first)
    index = _index(annotated, start, end)
    found = (F.col("UUID") == F.col("id")) & (F.col("day") == F.col("date"))
    return per_day.join(index, found, "left_anti").select(
        "UUID",
        F.col("first.TestTime").alias("Timestamp"),
        F.col("first.ServerX").alias("Server"),
        F.col("first.ClientX").alias("Client"),
        _slashed(F.col("day")).alias("year_month_day"),
    )


def missing_hops(traces: DataFrame, annotated: DataFrame, start: str, end: str) -> DataFrame:
    """One record per (hop ID, day) on a traced path that has no hop annotation."""
    hop = F.col("hop.Source.hopannotation1")
    fields = (
        _in_days(traces, start, end)
        .select("day", F.explode("Hop").alias("hop"))
        .select(
            "day",
            hop["ID"].alias("ID"),
            hop["Timestamp"].alias("Timestamp"),
            hop["Annotations"].alias("Annotations"),
            F.col("hop.Source.IP").alias("IP"),
        )
        .where((F.col("ID") != "") & F.col("Annotations").isNotNull())
    )
    first = F.min(F.struct("Timestamp", "Annotations", "IP")).alias("first")
    per_day = fields.groupBy("day", "ID", F.to_date("Timestamp").alias("hop_day")).agg(first)
    index = _index(annotated, start, end)
    found = (F.col("ID") == F.col("id_known")) & (
        F.abs(F.date_diff("day", "date_known")) <= 1
    )
    known = index.select(F.col("id").alias("id_known"), F.col("date").alias("date_known"))
    missing = per_day.join(known, found, "left_anti")
    # A path seen on two days around midnight can report one hop twice.
    once = missing.groupBy("ID", "hop_day").agg(F.min("first").alias("first"))
    return once.select(
        "ID",
        F.date_format("first.Timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Timestamp"),
        F.col("first.Annotations").alias("Annotations"),
        _slashed(F.col("hop_day")).alias("Date"),
        F.date_format("first.Timestamp", "yyyyMMdd'T000000Z'").alias("FilenameTimestamp"),
        F.nullif(F.regexp_extract("ID", HOST_IN_ID, 1), F.lit("")).alias("Hostname"),
        F.col("first.IP").alias("IP"),
    )


def _present(column: Column, schema) -> Column:
    """A struct without its empty fields: '' and 0 become NULL, which JSON leaves out."""
    kind = schema.typeName()
    if kind == "struct":
        fields = [_present(column[f.name], f.dataType).alias(f.name) for f in schema.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if kind == "string":
        return F.nullif(column, F.lit(""))
    if kind in ("double", "long", "integer"):
        return F.when(column != 0, column)
    return column


def _always(column: Column, schema) -> Column:
    """`_present` for a struct that is written even where it is NULL, then as {}."""
    none = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return F.coalesce(_present(column, schema), none)


def _json(record: Column) -> Column:
    """JSON text whose whole numbers have no fraction: 1, not 1.0.

    In texts every quotation mark has a backslash, so a bare `":1.0` only follows the name of a field.
    """
    return F.regexp_replace(F.to_json(record), r'(?<!\\)(":-?\d+)\.0(?=[,}])', "$1")


def _instant(time: Column) -> Column:
    text = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def connection_files(missing: DataFrame) -> DataFrame:
    """(path, content) of each missing connection annotation."""
    types = missing.schema
    record = F.struct(
        "UUID",
        _instant(F.col("Timestamp")).alias("Timestamp"),
        *[_always(F.col(c), types[c].dataType).alias(c) for c in ("Server", "Client")],
    )
    path = F.concat("year_month_day", F.lit("/"), "UUID", F.lit(".json"))
    return missing.select(path.alias("path"), _json(record).alias("content"))


def hop_files(missing: DataFrame) -> DataFrame:
    """(path, content) of each missing hop annotation."""
    kind = missing.schema["Annotations"].dataType
    record = F.struct(
        "ID", "Timestamp", _present(F.col("Annotations"), kind).alias("Annotations")
    )
    name = F.concat_ws(
        "_",
        "FilenameTimestamp",
        F.coalesce("Hostname", F.lit("<no value>")),
        F.coalesce("IP", F.lit("<no value>")),
    )
    path = F.concat("Date", F.lit("/"), name, F.lit(".json"))
    return missing.select(path.alias("path"), _json(record).alias("content"))

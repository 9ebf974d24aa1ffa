"""The library's inputs, derived from the given tables with Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _geo(**fields: Column) -> Column:
    """A geo struct; fields that are not given are NULL."""
    names = {
        "ContinentCode": "string", "CountryCode": "string", "CountryName": "string",
        "Region": "string", "Subdivision1ISOCode": "string", "Subdivision1Name": "string",
        "Subdivision2ISOCode": "string", "Subdivision2Name": "string", "City": "string",
        "PostalCode": "string", "Latitude": "double", "Longitude": "double",
        "AccuracyRadiusKm": "bigint",
    }
    return F.struct(
        *[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in names.items()]
    )


def _network(number: Column) -> Column:
    return F.struct(
        F.lit(None).cast("string").alias("CIDR"),
        number.cast("bigint").alias("ASNumber"),
        F.concat(F.lit("AS"), number.cast("string")).alias("ASName"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their country and continent."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return (
        read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name")
    )


def user_longitude(user: Column) -> Column:
    return (user * 7 % 360 - 180 + F.lit(0.5)).cast("double")


def user_latitude(user: Column) -> Column:
    return (user * 5 % 180 - 90 + F.lit(0.5)).cast("double")


def address(user: Column) -> Column:
    """An IPv4 address for each user number below 2^32 - 10 * 2^24."""
    parts = [F.lit(10) + F.floor(user / (1 << 24)), *[F.floor(user / (1 << s)) % 256 for s in (16, 8, 0)]]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def _missing(number: Column, every: int, value: Column) -> Column:
    """`value`, but NULL for one number in `every` and empty for another one."""
    return F.when(number % every == 0, F.lit(None)).when(number % every == 1, "").otherwise(value)


def _user_client(user: Column, event: Column) -> Column:
    """A client; some have no address, a bad or an IPv6 one, and some lack parts of their place."""
    segment, kind = F.col("c_mktsegment"), user % 47
    six = F.concat(F.lit("2001:db8::"), F.lower(F.hex(user % 65536)))
    text = (
        F.when(event % 37 == 0, F.lit(None))
        .when(event % 37 == 1, "10.0.0.256")
        .when(event % 37 == 2, six)
        .otherwise(address(user))
    )
    subdivision = (
        F.when(kind.isin(0, 1), F.lit(None))
        .when((kind == 2) | (user % 3 == 0), "")
        .when(user % 3 == 1, F.concat(F.lit("sub"), (user % 5).cast("string")))
        .otherwise(segment)
    )
    return F.struct(
        text.alias("IP"),
        _geo(
            ContinentCode=_missing(user, 53, F.col("r_name")),
            CountryCode=_missing(user, 59, F.col("n_name")),
            CountryName=F.col("n_name"),
            Region=F.when(kind.isin(1, 3), F.lit(None)).when(kind == 2, "").otherwise(segment),
            Subdivision1ISOCode=subdivision,
            City=_missing(user, 61, F.concat(F.lit("city"), (user % 7).cast("string"))),
            Longitude=user_longitude(user),
            Latitude=user_latitude(user),
        ).alias("Geo"),
        _network(F.when(user % 67 > 0, user % 9 + 64500)).alias("Network"),
    )


def _rtt() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed tests: one per event.

    Some have no speed, one next to a rounding tie, no id, or an id that others have too.
    """
    user, event = F.col("user_id"), F.col("event_id")
    again = F.concat(F.lit("again"), (user % 3).cast("string"))
    speed = F.when(event % 41 == 0, 0.0).when(event % 43 == 0, F.floor("value") + F.lit(0.3424999999))
    events = read(spark, sf_dir, "events")
    return events.join(places(spark, sf_dir), user == F.col("c_custkey")).select(
        F.to_date("ts").alias("date"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "dl")
        .otherwise("ul")
        .alias("direction"),
        F.when(event % 29 == 0, F.lit(None)).when(event % 31 == 0, again).otherwise(event.cast("string")).alias("id"),
        _user_client(user, event).alias("client"),
        F.struct(speed.otherwise(F.col("value")).alias("MeanThroughputMbps"), _rtt().alias("MinRTT")).alias("a"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger set of speed tests: one per line item, over several years."""
    customer = F.col("c_custkey")
    tests = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    day = F.to_date("l_shipdate")
    return tests.join(places(spark, sf_dir), F.col("o_custkey") == customer).select(
        day.alias("date"),
        F.when(F.col("l_linestatus") == "O", "dl").otherwise("ul").alias("direction"),
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day.cast("string")
        ).alias("id"),
        F.struct(
            F.concat_ws(
                ".", F.lit("10"), F.floor(customer / 65536).cast("string"),
                (F.floor(customer / 256) % 256).cast("string"), (customer % 256).cast("string"),
            ).alias("IP"),
            _geo(
                ContinentCode=F.col("r_name"),
                CountryCode=F.col("n_name"),
                Region=F.col("c_mktsegment"),
                City=F.concat(F.lit("city"), (customer % 7).cast("string")),
                Longitude=user_longitude(customer),
                Latitude=user_latitude(customer),
            ).alias("Geo"),
            _network(F.col("l_suppkey")).alias("Network"),
        ).alias("client"),
        F.struct(
            (F.col("l_extendedprice") / 10).alias("MeanThroughputMbps"),
            F.col("l_quantity").alias("MinRTT"),
        ).alias("a"),
    )


def _box(x: Column, y: Column, width: float, height: float) -> Column:
    """Closed rectangle ring with its low corner at (x, y)."""

    def at(dx: float, dy: float) -> Column:
        return F.struct(
            (x + F.lit(dx)).cast("double").alias("x"), (y + F.lit(dy)).cast("double").alias("y")
        )

    corners = [at(0, 0), at(width, 0), at(width, height), at(0, height), at(0, 0)]
    return F.array(F.array(*corners))


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One longitude band per nation, 14 degrees wide."""
    key = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").select(
        F.lpad(key.cast("string"), 2, "0").alias("geo_id"),
        _text("S", key).alias("state"),
        F.col("n_name").alias("state_name"),
        _box(key * 14 - 175, F.lit(-80), 14, 160).alias("rings"),
    )


def state_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bands with their polygons as text, two parts each."""
    key = F.col("n_nationkey")
    text = (
        "MULTIPOLYGON (((%1$s -80, %2$s -80, %2$s 0, %1$s 0, %1$s -80)), "
        "((%1$s 0, %2$s 0, %2$s 80, %1$s 80, %1$s 0)))"
    )
    west, east = (key * 14 - 175).cast("string"), (key * 14 - 161).cast("string")
    return read(spark, sf_dir, "nation").select(
        F.lpad(key.cast("string"), 2, "0").alias("geo_id"),
        _text("S", key).alias("state"),
        F.col("n_name").alias("state_name"),
        F.format_string(text, west, east).alias("state_geom"),
    )


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 10 by 6 degree rectangle per supplier."""
    key = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        _text("C", key).alias("geo_id"),
        F.col("s_name").alias("county_name"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("state_fips_code"),
        (key % 1000).cast("string").alias("county_fips_code"),
        _text("G", key).alias("county_gnis_code"),
        _text("County ", key).alias("lsad_name"),
        (key % 10).cast("string").alias("lsad_code"),
        F.lit("H1").alias("fips_class_code"),
        _box(key % 36 * 10 - 180, F.floor(key / 36) % 30 * 6 - 90, 10, 6).alias("rings"),
    )


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 4 by 3 degree rectangle per part."""
    key = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        _text("T", key).alias("geo_id"),
        _text("State ", key % 50).alias("state_name"),
        _text("Tract ", key).alias("tract_name"),
        F.col("p_type").alias("lsad_name"),
        _box(key % 90 * 4 - 180, F.floor(key / 90) % 60 * 3 - 90, 4, 3).alias("rings"),
    )


BOUNDARIES = {"states": states, "counties": counties, "tracts": tracts}


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address text per event: several spellings of IPv4 and IPv6, and texts that are neither."""
    user = F.col("user_id") % 65536
    quad = F.concat_ws(".", F.lit("10.0"), F.floor(user / 256).cast("string"), (user % 256).cast("string"))
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, quad)
        .when(kind == 1, F.concat(F.lit("2001:DB8::"), F.hex(user)))
        .when(kind == 2, F.concat(F.lit("2001:db8:0:0:0:0:0:"), F.lower(F.hex(user))))
        .when(kind == 3, F.concat(F.lit("::ffff:"), quad))
        .when(kind == 4, F.concat(F.lit("not-an-ip-"), user.cast("string")))
        .otherwise(F.concat(F.lit("300.1."), (user % 256).cast("string"), F.lit(".1")))
    )
    return read(spark, sf_dir, "events").select(kind.alias("kind"), text.alias("text"))


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw test rows with client metadata and server snapshots: one per event."""
    user, event = F.col("user_id"), F.col("event_id")
    download = event % 3 > 0

    def value(name: str, text: Column, missing: Column) -> Column:
        return F.struct(
            F.lit(name).alias("Name"), F.when(~missing, text).alias("Value")
        )

    metadata = F.array(
        value("client_name", _text("name", user % 3), user % 5 == 0),
        value("client_os", _text("os", user % 2), F.lit(False)),
        value("client_arch", F.lit("x86"), user % 4 == 0),
        value("client_library", F.lit("lib"), F.lit(False)),
        value("client_version", _text("v", user % 2), F.lit(False)),
    )
    scale = F.when(user % 10 == 0, 120).when(user % 10 < 9, 7).cast("bigint")
    snapshots = F.transform(
        F.sequence(F.lit(0), F.lit(4)),
        lambda i: F.struct(
            F.struct(
                scale.alias("wscale"),
                (event % 12 * 1000000 + i * 100000).cast("bigint").alias("ElapsedTime"),
                (event % 50).cast("bigint").alias("Retransmits"),
            ).alias("TCPInfo")
        ),
    )
    side = F.struct(
        metadata.alias("ClientMetadata"),
        F.slice(snapshots, 1, (event % 5).cast("int")).alias("ServerMeasurements"),
    )
    client = _user_client(user, event)
    version = F.concat_ws("-", F.lit("ndt"), _text("v", event % 3), event.cast("string"))
    return (
        read(spark, sf_dir, "events")
        .join(places(spark, sf_dir), user == F.col("c_custkey"))
        .select(
            F.when(event % 11 == 0, _text("x", event)).otherwise(version).alias("ID"),
            F.to_date("ts").alias("date"),
            F.struct(
                F.concat(F.col("event_type"), (user % 2).cast("string")).alias("Site"),
                _text("node", user % 4).alias("Machine"),
            ).alias("server"),
            F.struct(
                client["Geo"].alias("Geo"), client["Network"].alias("Network")
            ).alias("client"),
            F.struct(
                F.when(user % 50 == 7, "45.56.98.222").otherwise(address(user)).alias("ClientIP"),
                F.when(download, side).alias("Download"),
                F.when(~download, side).alias("Upload"),
            ).alias("raw"),
            F.struct(
                F.when(event % 13 > 0, event.cast("string")).alias("UUID"),
                F.col("ts").alias("TestTime"),
                F.lit("bbr").alias("CongestionControl"),
                F.col("value").alias("MeanThroughputMbps"),
                _rtt().alias("MinRTT"),
                (event % 8 / F.lit(8.0)).alias("LossRate"),
            ).alias("a"),
        )
    )


def _order_time(days: int) -> Column:
    """Order dates moved into the years of the backfills, at a second of the day."""
    return F.expr(f"timestampadd(SECOND, o_orderkey % 86400, timestampadd(DAY, {days}, o_orderdate))")


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection data: one row per order, two orders per connection."""
    order = F.col("o_orderkey")
    time = _order_time(8401)
    place = _geo(CountryCode=_text("N", F.col("o_custkey") % 25), Latitude=F.lit(0.0))
    return read(spark, sf_dir, "orders").select(
        F.when(order % 13 == 0, "").otherwise(_text("u", F.floor(order / 2))).alias("UUID"),
        time.alias("TestTime"),
        F.struct(
            F.when(order % 17 == 0, "").otherwise(_text("site", F.col("o_custkey") % 5)).alias("Site"),
            F.lit("node1").alias("Machine"),
            F.when(order % 19 != 0, place).alias("Geo"),
            _network(F.col("o_custkey") % 9).alias("Network"),
        ).alias("ServerX"),
        F.struct(place.alias("Geo"), _network(F.col("o_custkey") % 7).alias("Network")).alias("ClientX"),
        F.date_add(F.to_date(time), (order % 4 - 1).cast("int")).alias("part_date"),
    )


def connection_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections that are annotated: those of returned line items."""
    lines = read(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "A")
    orders = read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _text("u", F.floor(F.col("o_orderkey") / 2)).alias("id"),
        F.to_date(_order_time(8401)).alias("date"),
    )


def _hop_id() -> Column:
    part = F.col("l_partkey")
    named = F.concat(
        F.lit("2021_host"), (F.col("l_suppkey") % 50).cast("string"), F.lit("_"), part.cast("string")
    )
    return F.when(part % 23 == 0, "").when(part % 7 == 0, _text("plain", part)).otherwise(named)


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traced paths: one per order, a hop per line item."""
    orders = read(spark, sf_dir, "orders")
    lines = read(spark, sf_dir, "lineitem")
    time = _order_time(8900)
    annotations = F.struct(
        _geo(CountryCode=_text("N", F.col("l_suppkey") % 25), Longitude=F.lit(2.0)).alias("Geo"),
        _network(F.col("l_suppkey") % 9).alias("Network"),
    )
    hop = F.struct(
        F.struct(
            F.concat_ws(
                ".", F.lit("10.1"), (F.col("l_suppkey") % 256).cast("string"),
                F.col("l_linenumber").cast("string"),
            ).alias("IP"),
            F.struct(
                _hop_id().alias("ID"),
                F.expr("timestampadd(SECOND, l_linenumber, TestTime)").alias("Timestamp"),
                F.when(F.col("l_partkey") % 29 != 0, annotations).alias("Annotations"),
            ).alias("hopannotation1"),
        ).alias("Source")
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "TestTime", time
    )
    return joined.groupBy("o_orderkey", "TestTime").agg(F.collect_list(hop).alias("Hop")).select(
        "TestTime",
        F.date_add(F.to_date("TestTime"), (F.col("o_orderkey") % 4 - 1).cast("int")).alias("part_date"),
        "Hop",
    )


def hop_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hops that are annotated: those of line items that were not returned."""
    lines = read(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "N")
    orders = read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _hop_id().alias("id"),
        F.date_add(F.to_date(_order_time(8900)), F.col("l_linenumber") % 3 - 1).alias("date"),
    )


def _block(part: Column) -> Column:
    return F.lpad((part * 982451653).cast("string"), 15, "0")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broadband filings: one per line item."""
    quantity = F.col("l_quantity")
    speed = F.when(F.col("l_linenumber") == 7, "").otherwise(quantity.cast("string"))
    return read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "1").otherwise("0").alias("Consumer"),
        F.col("l_suppkey").cast("string").alias("Provider_Id"),
        _block(F.col("l_partkey")).alias("BlockCode"),
        speed.alias("MaxAdDown"),
        (quantity / 2).cast("string").alias("MaxAdUp"),
    )


def statistics(spark: SparkSession, sf_dir: str, digits: int) -> DataFrame:
    """Daily bucket rows of counties (5 digits) or tracts (11): one per line item."""
    line = F.col("l_linenumber")
    edge = (
        F.when(line == 1, 0.0)
        .when(line == 2, 1.7782794100389228)
        .when(line == 3, 5.623413251903491)
        .when(line == 4, 17.78279410038923)
        .otherwise(56.23413251903491)
    )
    return read(spark, sf_dir, "lineitem").select(
        F.substring(_block(F.col("l_partkey")), 1, digits).alias("fips"),
        F.to_date("l_shipdate").cast("string").alias("date"),
        edge.alias("bucket_min"),
        F.col("l_quantity").cast("bigint").alias("dl_samples_bucket"),
        (F.col("l_extendedprice") / 10).alias("download_MED"),
        (F.col("l_suppkey") % 40).alias("ul_samples_bucket"),
        (F.col("l_extendedprice") / 20).alias("upload_MED"),
    )


def tract_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map features: one per part."""
    block = _block(F.col("p_partkey"))
    return read(spark, sf_dir, "part").select(
        F.substring(block, 1, 2).alias("STATEFP10"),
        F.substring(block, 3, 3).alias("COUNTYFP10"),
        F.substring(block, 6, 6).alias("TRACTCE10"),
        F.col("p_name").alias("name"),
    )


def tract_of(part: Column) -> Column:
    return F.substring(_block(part), 1, 11)


def tract_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map features with a rectangle each, as GeoJSON geometry."""
    key = F.col("p_partkey")
    block, rings = _block(key), _box(key % 90 * 4 - 180, F.floor(key / 90) % 60 * 3 - 90, 4, 3)
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    shape = F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates"))
    return read(spark, sf_dir, "part").select(
        tract_of(key).alias("fips"),
        F.substring(block, 1, 2).alias("STATEFP10"),
        F.substring(block, 3, 3).alias("COUNTYFP10"),
        F.substring(block, 6, 6).alias("TRACTCE10"),
        F.col("p_name").alias("name"),
        F.to_json(shape).alias("geometry"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Populations of three parts in four; some are empty."""
    size = F.col("p_size")
    total = F.when(size % 10 == 0, 0).otherwise(size * 64).cast("double")
    groups = {"white": 32, "black": 16, "asian": 8, "hispanic": 4, "amerindian": 2}
    return read(spark, sf_dir, "part").where(F.col("p_partkey") % 4 > 0).select(
        F.substring(_block(F.col("p_partkey")), 1, 11).alias("geo_id"),
        total.alias("total_pop"),
        *[(size * n).cast("double").alias(f"{g}_pop") for g, n in groups.items()],
    )


def internet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households with broadband of two parts in three."""
    return read(spark, sf_dir, "part").where(F.col("p_partkey") % 3 > 0).select(
        F.substring(_block(F.col("p_partkey")), 1, 11).alias("fips"),
        F.col("p_retailprice").alias("broadband"),
    )


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rhombs with a rhombic hole: one per supplier."""
    key = F.col("s_suppkey")
    cx, cy = key * 37 % 340 - 170, key * 17 % 160 - 80

    def ring(scale: float) -> Column:
        a, b = F.lit(7.3137 * scale), F.lit(5.7091 * scale)
        corners = [(cx + a, cy + 0.0), (cx + 0.0, cy + b), (cx - a, cy + 0.0), (cx + 0.0, cy - b)]
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])

    return read(spark, sf_dir, "supplier").select(
        _text("D", key).alias("geo_id"), F.array(ring(1.0), ring(0.25)).alias("rings")
    )


def globe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rhombs with a hole, also across the antimeridian, one per supplier; and a cap around a pole per nation."""
    key = F.col("s_suppkey")
    cx, cy = key * 37 % 360 - 180, key * 17 % 150 - 75

    def ring(scale: float) -> Column:
        a, b = F.lit(23.137 * scale), F.lit(9.091 * scale)
        corners = [(cx + a, cy + 0.0), (cx + 0.0, cy + b), (cx - a, cy + 0.0), (cx + 0.0, cy - b)]
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])

    rhombs = read(spark, sf_dir, "supplier").select(
        _text("D", key).alias("geo_id"), F.array(ring(1.0), ring(0.25)).alias("rings")
    )
    nation = F.col("n_nationkey")
    lat = F.when(nation % 2 == 0, nation + 45.25).otherwise(-45.25 - nation)
    corners = [F.struct((nation * 7 - 180 + 90.0 * i).alias("x"), lat.alias("y")) for i in range(4)]
    caps = read(spark, sf_dir, "nation").select(
        _text("P", nation).alias("geo_id"), F.array(F.array(*corners)).alias("rings")
    )
    return rhombs.union(caps)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        (key * 7919 % 36000 / F.lit(100.0) - 180 + 0.005).alias("lon"),
        (key * 104729 % 18000 / F.lit(100.0) - 90 + 0.005).alias("lat"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit squares, forty to a row: one per part. Four by five of them make a tract."""
    key = F.col("p_partkey")
    x, y = key % 40, F.floor(key / 40)
    tract = F.concat_ws("-", F.floor(x / 4).cast("string"), F.floor(y / 5).cast("string"))
    return read(spark, sf_dir, "part").select(
        tract.alias("tract"),
        F.floor(y / 50).cast("string").alias("state"),
        _box(x, y, 1, 1).alias("rings"),
    )


def blocks_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`blocks` without every eleventh. Gaps never touch; they are notches and holes of their tracts."""
    key = F.col("p_partkey")
    x, y = key % 40, F.floor(key / 40)
    tract = F.concat_ws("-", F.floor(x / 4).cast("string"), F.floor(y / 5).cast("string"))
    kept = read(spark, sf_dir, "part").where(key % 11 != 5)
    return kept.select(tract.alias("tract"), _box(x, y, 1, 1).alias("rings"))

"""The fifteen aggregation levels: one pipeline, fifteen parameter sets."""

from __future__ import annotations

from dataclasses import dataclass, replace

REGION = "ISO3166_2region1"
FILE = "{year}/histogram_daily_stats.json"


@dataclass(frozen=True)
class Level:
    """One aggregation level.

    keys         group columns besides `date`
    shard_by     column whose fingerprint gives the shard number, and how many shards
    path         output path template, fields in braces
    order        row order inside an exported file
    ip_text_only keep rows whose address text is present even if it does not parse
    boundary     polygon layer that supplies GEOID and names, if any
    may_be_empty string keys that must be present but may be ''
    attributes   columns of the boundary layer added after aggregation
    """

    name: str
    table: str
    keys: tuple[str, ...]
    shard_by: tuple[str, int]
    path: str
    order: tuple[str, ...]
    ip_text_only: bool = False
    boundary: str | None = None
    may_be_empty: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()

    @property
    def has_region(self) -> bool:
        return REGION in self.keys and self.boundary is None


def _with_asn(level: Level, shard_by: tuple[str, int]) -> Level:
    order = [c for c in level.order if c not in ("date", "bucket_min")]
    return replace(
        level,
        name=level.name + "_asn",
        table=level.table + "_asn",
        keys=(*level.keys, "asn"),
        shard_by=shard_by,
        path=level.path.replace(FILE, "asn/{asn}/" + FILE),
        order=(*order, "asn", "date", "bucket_min"),
    )


_PLACE = ("continent_code", "country_code", REGION, "city")

COUNTY_ATTRIBUTES = (
    "county_name",
    "state_fips_code",
    "county_fips_code",
    "county_gnis_code",
    "lsad_name",
    "lsad_code",
    "fips_class_code",
)

continents = Level(
    "continents", "continents", _PLACE[:1], ("continent_code", 1000),
    "v0/{continent_code}/" + FILE, ("continent_code", "date"),
)
countries = Level(
    "countries", "countries", _PLACE[:2], ("country_code", 1000),
    "v0/{continent_code}/{country_code}/" + FILE, (*_PLACE[:2], "date", "bucket_min"),
)
regions = Level(
    "regions", "regions", _PLACE[:3], ("country_code", 1000),
    "v0/{continent_code}/{country_code}/{" + REGION + "}/" + FILE,
    (*_PLACE[:3], "date", "bucket_min"), ip_text_only=True,
)
cities = Level(
    "cities", "cities", _PLACE, ("city", 4000),
    "v0/{continent_code}/{country_code}/{" + REGION + "}/{city}/" + FILE,
    (*_PLACE, "date", "bucket_min"), ip_text_only=True,
)
states = Level(
    "states", "us_states",
    ("continent_code", "country_code", REGION, "GEOID", "state", "state_name"), ("state", 4000),
    "v0/NA/US/states/{GEOID}/" + FILE, ("GEOID", "date", "bucket_min"),
    boundary="states", may_be_empty=(REGION, "state_name"),
)
counties = Level(
    "counties", "us_counties", ("continent_code", "country_code", "state", "GEOID"),
    ("state", 4000), "v0/NA/US/counties/{GEOID}/" + FILE, ("GEOID", "date", "bucket_min"),
    boundary="counties", attributes=COUNTY_ATTRIBUTES,
)
tracts = Level(
    "tracts", "us_tracts",
    ("continent_code", "country_code", "state", "state_name", "tract_name", "lsad_name", "GEOID"),
    ("GEOID", 4000), "v0/NA/US/tracts/{GEOID}/" + FILE, ("GEOID", "date", "bucket_min"),
    boundary="tracts",
)
global_asn = Level(
    "global_asn", "global_asn", ("asn",), ("asn", 1000),
    "v0/asn/{asn}/" + FILE, ("asn", "date", "bucket_min"),
)

LEVELS: dict[str, Level] = {
    level.name: level
    for level in (
        continents,
        _with_asn(continents, ("continent_code", 1000)),
        countries,
        _with_asn(countries, ("asn", 4000)),
        regions,
        _with_asn(regions, ("asn", 1000)),
        cities,
        _with_asn(cities, ("asn", 4000)),
        states,
        _with_asn(states, ("GEOID", 4000)),
        counties,
        _with_asn(counties, ("state", 4000)),
        tracts,
        _with_asn(tracts, ("GEOID", 4000)),
        global_asn,
    )
}

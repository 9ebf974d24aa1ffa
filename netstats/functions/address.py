"""Client addresses in a canonical text form, so that equal addresses group together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_GROUPS = r"[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*"
_IPV6 = rf"^(?:{_GROUPS})?(?:::(?:{_GROUPS})?)?$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once and may be used many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _quad_to_groups(text: Column) -> Column:
    """Rewrite a trailing dotted quad of an IPv6 text as two hex groups."""
    quad = F.regexp_extract(text, rf":({_IPV4})$", 1)
    pairs = F.transform(
        F.split(quad, r"\."), lambda octet: F.lpad(F.hex(octet.try_cast("bigint")), 2, "0")
    )
    groups = F.regexp_replace(F.lower(F.array_join(pairs, "")), "^(.{4})", "$1:")
    return F.concat(F.regexp_replace(text, rf"(?<=:){_IPV4}$", ""), groups)


def _groups(text: Column) -> Column:
    return F.transform(
        F.filter(F.split(text, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0")
    )


def _expand(text: Column) -> Column:
    """Eight full groups, with the zeros that '::' stands for; NULL if they do not add up."""
    halves = F.transform(F.split(text, "::"), _groups)
    given = F.size(F.flatten(halves))
    left, right = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))
    filled = F.concat(left, F.array_repeat(F.lit("0000"), 8 - given), right)
    return (
        F.when(~text.rlike(_IPV6), F.lit(None))
        .when((F.size(halves) == 2) & (given < 8), F.array_join(filled, ":"))
        .when((F.size(halves) == 1) & (given == 8), F.array_join(left, ":"))
    )


def _ipv6(ip: Column) -> Column:
    plain = F.when(F.contains(ip, F.lit(".")), _quad_to_groups(F.lower(ip))).otherwise(F.lower(ip))
    return _let(plain, _expand)


def parse_ip(ip: Column) -> Column:
    """Canonical form of an IPv4 or IPv6 address; NULL when the text is neither.

    IPv4 has one spelling already. IPv6 becomes eight four-digit groups. All of
    it runs inside the JVM; the IPv6 branch is only evaluated where it is needed.
    """
    return F.when(ip.rlike(rf"^{_IPV4}$"), ip).when(F.contains(ip, F.lit(":")), _ipv6(ip))

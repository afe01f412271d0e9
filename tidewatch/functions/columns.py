"""Column expressions shared by the detectors and the indicator jobs.

All of these are built-in Catalyst expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Host part of a URL indicator (scheme optional, up to first '/').
URL_HOST_PATTERN = r"(?:https?://)?([^/]+)"
# Stricter host rule: any scheme, no userinfo, no port, bracketed IPv6 unwrapped.
STRICT_HOST_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?(?:\[([^\]]+)\]|([^/:?#]+))"


# A bracketed IPv6 address, and a name or IPv4 address before a port.
BRACKETED_PATTERN = r"^\[([^\]]+)\](?::[0-9]+)?$"
NAME_PORT_PATTERN = r"^([^:]+):[0-9]+$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_strings() -> Column:
    """A typed, empty array<string> literal."""
    return F.array().cast(T.ArrayType(T.StringType()))


def url_host(url: str | Column) -> Column:
    return F.regexp_extract(col(url), URL_HOST_PATTERN, 1)


def match_key(ioc: str | Column = "ioc", ioc_type: str | Column = "ioc_type", strict: bool = False) -> Column:
    """The value an indicator is matched on.

    `ip:port` -> the text before the first ':'; `url` -> the host part;
    anything else as is. `strict=True` also lower-cases, drops user info and
    port for any scheme, and unwraps bracketed IPv6.
    """
    ioc, ioc_type = col(ioc), col(ioc_type)
    if not strict:
        return (
            F.when(ioc_type == "ip:port", F.split(ioc, ":", 2).getItem(0))
            .when(ioc_type == "url", url_host(ioc))
            .otherwise(ioc)
        )
    bracketed = F.regexp_extract(ioc, STRICT_HOST_PATTERN, 1)
    plain = F.regexp_extract(ioc, STRICT_HOST_PATTERN, 2)
    host = F.lower(F.when(bracketed != "", bracketed).otherwise(plain))
    ipv6_port = F.regexp_extract(ioc, r"^\[([^\]]+)\]", 1)
    ip_part = F.when(ipv6_port != "", F.lower(ipv6_port)).otherwise(F.split(ioc, ":", 2).getItem(0))
    return (
        F.when(ioc_type == "ip:port", ip_part)
        .when(ioc_type == "url", host)
        .otherwise(normal_value(ioc))
    )


def normal_value(value: str | Column) -> Column:
    """A log value under the strict rule: lower case, trimmed, without a port
    (`name:80`, `[v6]:80`) or IPv6 brackets; a bare IPv6 address stays."""
    v = F.lower(F.trim(col(value)))
    bracketed = F.regexp_extract(v, BRACKETED_PATTERN, 1)
    named = F.regexp_extract(v, NAME_PORT_PATTERN, 1)
    return F.when(bracketed != "", bracketed).when(named != "", named).otherwise(v)


def window_epoch(window: str | Column = "window") -> Column:
    """Start of an event-time window as epoch seconds (time-zone free)."""
    return F.unix_seconds(col(window).getField("start"))


def alert_id(alert_type: str, window: str | Column, *key: str | Column) -> Column:
    """Replay-stable alert id: sha256 of type, window start and the group key.

    Unlike an id built from processing time, the same input always gives the
    same id, so a sink can de-duplicate redelivered alerts by it.
    """
    parts = [F.lit(alert_type), window_epoch(window).cast("string")]
    parts += [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    return F.sha2(F.concat_ws("|", *parts), 256)


def sorted_set(arr: str | Column) -> Column:
    """Distinct, null-free, sorted copy of an array (stable set output)."""
    return F.array_sort(F.array_distinct(F.array_compact(col(arr))))


def ipv4_to_long(ip: str | Column) -> Column:
    """Dotted IPv4 text to its 32-bit value as a long; null if not IPv4."""
    ip = col(ip)
    octets = F.split(ip, r"\.")
    valid = ip.rlike(r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")
    value = (
        F.shiftleft(octets.getItem(0).cast("long"), 24)
        + F.shiftleft(octets.getItem(1).cast("long"), 16)
        + F.shiftleft(octets.getItem(2).cast("long"), 8)
        + octets.getItem(3).cast("long")
    )
    return F.when(valid, value)


def parse_feed_time(text: str | Column, shift_hours: int = 0) -> Column:
    """Feed timestamp text `yyyy-MM-dd HH:mm:ss[ UTC]` to a UTC timestamp.

    Bad text gives null (never an ANSI error). The text is read as UTC
    whatever the session zone, then shifted by `shift_hours`.
    """
    bare = F.trim(F.regexp_replace(col(text), "UTC", ""))
    ts = F.try_to_timestamp(F.concat(bare, F.lit(" +0000")), F.lit("yyyy-MM-dd HH:mm:ss Z"))
    return F.timestamp_add("HOUR", F.lit(shift_hours), ts) if shift_hours else ts

"""Column enrichment of log rows: address locality, service name by port,
HTTP reason phrase by status code.

The lookup tables are a handful of entries, so they are compiled into the
expression itself (a literal map / masked compares): no join, no shuffle,
and the lookup stays inside whole-stage codegen.
"""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import col, ipv4_to_long

# The monitored network segments (name, CIDR).
SEGMENTS = (
    ("corp-users", "10.10.10.0/24"),
    ("datacenter", "10.20.20.0/24"),
    ("dmz", "10.30.30.0/24"),
)
# Service name by well-known port; other ports give "-".
SERVICE_BY_PORT = {21: "ftp", 22: "ssh", 25: "smtp", 53: "dns", 80: "http", 110: "pop3", 143: "imap", 443: "ssl"}
UNKNOWN_SERVICE = "-"
# HTTP reason phrase by status code; other codes give null.
STATUS_TEXT = {
    200: "OK", 201: "Created", 204: "No Content", 301: "Moved Permanently", 302: "Found",
    400: "Bad Request", 401: "Unauthorized", 403: "Forbidden", 404: "Not Found",
    500: "Internal Server Error",
}


def _literal_map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def in_segments(ip: str | Column, segments=SEGMENTS) -> Column:
    """True when the IPv4 address lies in any segment; false otherwise
    (null or non-IPv4 text counts as not local)."""
    v = ipv4_to_long(ip)
    tests = []
    for _, cidr in segments:
        net = ipaddress.ip_network(cidr)
        mask = int(net.netmask)
        tests.append(v.bitwiseAND(F.lit(mask)) == F.lit(int(net.network_address)))
    hit = tests[0]
    for t in tests[1:]:
        hit = hit | t
    return F.coalesce(hit, F.lit(False))


def segment_of(ip: str | Column, segments=SEGMENTS) -> Column:
    """Name of the segment holding the address, else null."""
    v = ipv4_to_long(ip)
    out = None
    for name, cidr in segments:
        net = ipaddress.ip_network(cidr)
        cond = v.bitwiseAND(F.lit(int(net.netmask))) == F.lit(int(net.network_address))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def with_locality(df: DataFrame, segments=SEGMENTS) -> DataFrame:
    """Fill `local_orig` / `local_resp` from segment membership."""
    return df.withColumns({
        "local_orig": in_segments("id_orig_h", segments),
        "local_resp": in_segments("id_resp_h", segments),
    })


def service_name(port: str | Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(SERVICE_BY_PORT), col(port)), F.lit(UNKNOWN_SERVICE))


def with_service(df: DataFrame, port: str = "id_resp_p") -> DataFrame:
    return df.withColumn("service", service_name(port))


def status_message(code: str | Column) -> Column:
    return F.try_element_at(_literal_map(STATUS_TEXT), col(code))


def with_status_message(df: DataFrame, code: str = "status_code") -> DataFrame:
    return df.withColumn("status_msg", status_message(code))

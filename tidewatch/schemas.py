"""Typed schemas for sensor logs, alerts and threat indicators.

Every field is nullable: sensors omit fields freely and the decoder must turn
an absent field into null rather than fail.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B, _TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
    T.BooleanType(), T.TimestampType(),
)
_AS, _AI = T.ArrayType(_S), T.ArrayType(_I)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The conn / http / dns field lists of the sensor log format, in
# sensor order. Names and types must stay exactly as the sensor writes them.
CONN_SCHEMA = _struct(
    ("@path", _S), ("sensor_name", _S), ("ts", _TS), ("uid", _S),
    ("id.orig_h", _S), ("id.orig_p", _I), ("id.resp_h", _S), ("id.resp_p", _I),
    ("proto", _S), ("service", _S), ("duration", _D), ("orig_bytes", _L),
    ("resp_bytes", _L), ("conn_state", _S), ("local_orig", _B), ("local_resp", _B),
    ("missed_bytes", _L), ("history", _S), ("orig_pkts", _L), ("orig_ip_bytes", _L),
    ("resp_pkts", _L), ("resp_ip_bytes", _L), ("tunnel_parents", _AS),
    ("orig_l2_addr", _S), ("resp_l2_addr", _S), ("orig_cc", _S), ("resp_cc", _S),
    ("community_id", _S), ("notice", _S),
)
HTTP_SCHEMA = _struct(
    ("@path", _S), ("sensor_name", _S), ("ts", _TS), ("uid", _S),
    ("id.orig_h", _S), ("id.orig_p", _I), ("id.resp_h", _S), ("id.resp_p", _I),
    ("trans_depth", _I), ("method", _S), ("host", _S), ("uri", _S), ("referrer", _S),
    ("version", _S), ("user_agent", _S), ("request_body_len", _L),
    ("response_body_len", _L), ("status_code", _I), ("status_msg", _S), ("tags", _AS),
    ("proxied", _AS), ("orig_fuids", _AS), ("orig_filenames", _AS),
    ("orig_mime_types", _AS), ("resp_fuids", _AS), ("resp_filenames", _AS),
    ("resp_mime_types", _AS),
)
DNS_SCHEMA = _struct(
    ("@path", _S), ("sensor_name", _S), ("ts", _TS), ("uid", _S),
    ("id.orig_h", _S), ("id.orig_p", _I), ("id.resp_h", _S), ("id.resp_p", _I),
    ("proto", _S), ("trans_id", _I), ("rtt", _D), ("query", _S), ("qclass", _I),
    ("qclass_name", _S), ("qtype", _I), ("qtype_name", _S), ("rcode", _I),
    ("rcode_name", _S), ("AA", _B), ("TC", _B), ("RD", _B), ("RA", _B), ("Z", _I),
    ("answers", _AS), ("TTLs", _AI), ("rejected", _B),
)

# Dotted connection-tuple names and their flat column names.
ID_RENAMES = {
    "id.orig_h": "id_orig_h",
    "id.orig_p": "id_orig_p",
    "id.resp_h": "id_resp_h",
    "id.resp_p": "id_resp_p",
}


def merge_schemas(*schemas: T.StructType) -> T.StructType:
    """Union of fields by name; the first schema that names a field wins.

    A field repeated with a different type is an error: a silent first-wins
    would decode the later log kind into the wrong type.
    """
    seen: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            prior = seen.get(field.name)
            if prior is None:
                seen[field.name] = field
            elif prior.dataType != field.dataType:
                raise TypeError(
                    f"field {field.name!r}: {prior.dataType.simpleString()} vs "
                    f"{field.dataType.simpleString()}"
                )
    return T.StructType(list(seen.values()))


# Wire schema: what a sensor record decodes to (dotted names, 65 fields).
WIRE_SCHEMA = merge_schemas(CONN_SCHEMA, HTTP_SCHEMA, DNS_SCHEMA)

# Wide schema: wire schema with the connection tuple flattened.
WIDE_SCHEMA = T.StructType(
    [T.StructField(ID_RENAMES.get(f.name, f.name), f.dataType, True) for f in WIRE_SCHEMA.fields]
)

ALERT_SCHEMA = _struct(
    ("alert_id", _S), ("log_uid", _S), ("alert_type", _S), ("severity", _S),
    ("alert_ts", _TS), ("event_ts", _TS), ("orig_ip", _S), ("resp_ip", _S),
    ("ioc_score", _I), ("ioc_source", _AS), ("ioc_value", _AS), ("tags", _AS),
)

# One indicator inside a raw feed document. `confidence_level` is read as text
# so that a number, a quoted number or junk all decode; cleaning casts it.
RAW_IOC_ENTRY = _struct(
    ("id", _S), ("ioc", _S), ("threat_type", _S), ("ioc_type", _S), ("malware", _S),
    ("malware_printable", _S), ("confidence_level", _S), ("first_seen", _S),
    ("last_seen", _S), ("reference", _S), ("reporter", _S), ("tags", _AS),
    ("is_compromised", _B),
)
# One raw feed document as pulled from the indicator service. On read the
# indicators stay JSON text, so that fields outside the entry above survive.
RAW_IOC_DOCUMENT = _struct(("query_status", _S), ("data", T.ArrayType(RAW_IOC_ENTRY)))
RAW_IOC_TEXT_DOCUMENT = _struct(("query_status", _S), ("data", T.ArrayType(_S)))
# Hive partition columns of the raw landing area.
RAW_PARTITIONS = ("year", "month", "day")

CLEAN_IOC_SCHEMA = _struct(
    ("id", _S), ("ioc", _S), ("threat_type", _S), ("ioc_type", _S), ("malware", _S),
    ("malware_printable", _S), ("confidence_level", _I), ("first_seen", _TS),
    ("last_seen", _TS), ("reference", _S), ("reporter", _S), ("tags", _AS),
    ("is_compromised", _B), ("extra", _S),
)

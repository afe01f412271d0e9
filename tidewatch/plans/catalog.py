"""Registered queries: each is a Spark job over the driver tables plus, where
the semantics are SQL-expressible, the same query as DuckDB SQL (the oracle).

Spark builders take (spark, sf_dir) and return an un-collected DataFrame.
Oracle SQL runs on DuckDB views named like the driver tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import alert_id
from tidewatch.operators import detect, enrich, sketches
from tidewatch.operators import iocs as ops
from tidewatch.operators.iocs import with_match_key
from tidewatch.operators.prefixes import with_segment
from tidewatch.plans.checkable import checkable, sql_text
from tidewatch.plans.ioc_refresh import run_ioc_refresh
from tidewatch.plans.landing import follow_landing
from tidewatch.schemas import CLEAN_IOC_SCHEMA, WIDE_SCHEMA
from tidewatch.session import work_dir
from tidewatch.sinks.outputs import alert_documents, alert_json, decode_alerts, land_raw, log_documents
from tidewatch.sources import fixtures as fx
from tidewatch.sources.iocs import read_iocs, read_raw
from tidewatch.sources.logs import conform_wide, decode_logs, encode_logs
from tidewatch.streaming.feed import event_bounds, replay_alerts, replay_documents, replay_drops, replay_through, replay_upserts, write_closing

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def wrap(fn: Builder) -> Builder:
        REGISTRY[name] = Query(lambda spark, sf: checkable(fn(spark, sf)), sql, note)
        return fn

    return wrap


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ----------------------------------------------------------- shared SQL parts

_DUCK_TYPE = {
    T.StringType: "VARCHAR", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP",
}
_NET_COLUMNS = {"ts", "uid", "id_orig_h", "id_resp_h", "id_resp_p", "orig_bytes", "query", "answers", "host"}


def _wide_select_sql() -> str:
    cols = []
    for f in WIDE_SCHEMA.fields:
        src = "log_path" if f.name == "@path" else f.name
        if src in _NET_COLUMNS or src == "log_path":
            expr = sql_text(src) if isinstance(f.dataType, T.ArrayType) else src
        elif isinstance(f.dataType, T.ArrayType):
            expr = "CAST(NULL AS VARCHAR)"
        else:
            expr = f"CAST(NULL AS {_DUCK_TYPE[type(f.dataType)]})"
        cols.append(f'{expr} AS "{f.name}"')
    return "SELECT " + ", ".join(cols) + " FROM net"


def _bucket(seconds: int) -> str:
    return f"CAST(floor(epoch_ms(ts) / {seconds * 1000}) * {seconds} AS BIGINT)"


def _id(alert_type: str, *key: str) -> str:
    parts = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key)
    return f"sha256(concat_ws('|', '{alert_type}', CAST(ws AS VARCHAR), {parts}))"


PAIRS_CTE = f"""
pairs AS (
  SELECT {_bucket(60)} AS ws, id_orig_h, id_resp_h,
         count(DISTINCT id_resp_p) AS port_count,
         CAST(sum(orig_bytes) AS BIGINT) AS total_bytes,
         min(ts) AS event_ts,
         first(uid ORDER BY ts ASC NULLS FIRST, uid ASC NULLS FIRST) AS first_uid
  FROM net WHERE ts IS NOT NULL
  GROUP BY ALL
)"""

PORT_SCAN_SELECT = f"""
SELECT {_id('Port Scanning', 'id_orig_h', 'id_resp_h')} AS alert_id,
       CAST(NULL AS VARCHAR) AS log_uid, 'Port Scanning' AS alert_type,
       CASE WHEN port_count > 12.0 THEN 'High' ELSE 'Medium' END AS severity,
       event_ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, CAST(NULL AS INTEGER) AS ioc_score,
       '' AS ioc_source, '' AS ioc_value,
       'port_scan|ports_count:' || CAST(port_count AS VARCHAR) AS tags
FROM pairs WHERE port_count >= 8"""

EXFIL_SELECT = f"""
SELECT {_id('Data Exfiltration', 'id_orig_h', 'id_resp_h')} AS alert_id,
       first_uid AS log_uid, 'Data Exfiltration' AS alert_type,
       CASE WHEN total_bytes > 200000000 THEN 'High' ELSE 'Medium' END AS severity,
       event_ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, CAST(NULL AS INTEGER) AS ioc_score,
       '' AS ioc_source, '' AS ioc_value,
       'data_exfiltration|data_exfiltration_mb:' || CAST(total_bytes / 1000000 AS VARCHAR) AS tags
FROM pairs WHERE total_bytes > 100000000"""

KEYS_CTE = """
keys AS (
  SELECT CASE WHEN ioc_type = 'ip:port' THEN split_part(ioc, ':', 1)
              WHEN ioc_type = 'url' THEN regexp_extract(ioc, '(?:https?://)?([^/]+)', 1)
              ELSE ioc END AS ioc_for_match, *
  FROM iocs
)"""

EVENTS_CTE = """
ev AS (
  SELECT uid, ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, query, host,
         unnest(CASE WHEN answers IS NULL OR len(answers) = 0 THEN [NULL::VARCHAR] ELSE answers END) AS answer
  FROM net
)"""

CANDIDATES_CTE = """
cand AS (
  SELECT uid, ts, orig_ip, resp_ip, query, answer, host, resp_ip AS match_value FROM ev WHERE resp_ip IS NOT NULL
  UNION ALL SELECT uid, ts, orig_ip, resp_ip, query, answer, host, query FROM ev WHERE query IS NOT NULL
  UNION ALL SELECT uid, ts, orig_ip, resp_ip, query, answer, host, answer FROM ev WHERE answer IS NOT NULL
  UNION ALL SELECT uid, ts, orig_ip, resp_ip, query, answer, host, host FROM ev WHERE host IS NOT NULL
)"""

IOC_MATCH_SELECT = f"""
SELECT {_id('IOC Match', 'uid')} AS alert_id, uid AS log_uid, 'IOC Match' AS alert_type,
       CASE WHEN compromised THEN 'High' ELSE 'Medium' END AS severity,
       event_ts, orig_ip, resp_ip, ioc_score,
       {sql_text('ioc_source')} AS ioc_source, {sql_text('ioc_value')} AS ioc_value, {sql_text('tags')} AS tags
FROM (
  SELECT {_bucket(5)} AS ws, uid,
         min(ts) AS event_ts,
         first(orig_ip ORDER BY ts ASC NULLS FIRST, resp_ip ASC NULLS FIRST, orig_ip ASC NULLS FIRST) AS orig_ip,
         first(resp_ip ORDER BY ts ASC NULLS FIRST, resp_ip ASC NULLS FIRST, orig_ip ASC NULLS FIRST) AS resp_ip,
         CAST(max(confidence_level) AS INTEGER) AS ioc_score,
         list_sort(list_distinct(list(ioc))) AS ioc_value,
         list_sort(list_distinct(list(reporter))) AS ioc_source,
         list_sort(list_distinct(flatten(list(coalesce(tags, []))))) AS tags,
         bool_or(coalesce(is_compromised, false)) AS compromised
  FROM cand c JOIN keys k ON c.match_value = k.ioc_for_match
  WHERE ts IS NOT NULL
  GROUP BY ALL
)"""


# -------------------------------------------------------------- log decoding

@register("wide_logs", _with(fx.NET_SQL) + _wide_select_sql())
def q_wide_logs(spark, sf):
    """Sensor rows conformed to the 65-column wide schema."""
    return conform_wide(fx.net(spark, sf))


@register("decode_logs", _with(fx.NET_SQL) + _wide_select_sql())
def q_decode_logs(spark, sf):
    """Wide rows -> sensor JSON -> decoded again: the stream's decode path."""
    return decode_logs(encode_logs(fx.net(spark, sf)))


# ----------------------------------------------------------------- detectors

@register("port_scan_exact", _with(fx.NET_SQL, PAIRS_CTE) + PORT_SCAN_SELECT)
def q_port_scan_exact(spark, sf):
    return detect.port_scan(fx.net(spark, sf, hosts=False))


# The approximate count has a relative standard deviation of 0.05: four of
# them, and one for rounding, bound the difference of every group.
@register("port_scan_approx", _with(fx.NET_SQL, PAIRS_CTE) + (
    "SELECT count(*) AS n_groups, CAST(sum(port_count) AS BIGINT) AS n_ports, CAST(0 AS BIGINT) AS outside_bound FROM pairs"))
def q_port_scan_approx(spark, sf):
    """Approximate against exact port counts of every (window, pair) group."""
    n = fx.net(spark, sf, hosts=False)
    counts = n.groupBy(F.window("ts", detect.DEFAULT.pair_window), "id_orig_h", "id_resp_h").agg(
        detect.port_count(exact=True).alias("exact"), detect.port_count(exact=False).alias("approx"))
    outside = F.abs(F.col("approx") - F.col("exact")) > 4 * 0.05 * F.col("exact") + 1
    return counts.agg(F.count(F.lit(1)).alias("n_groups"), F.sum("exact").cast("long").alias("n_ports"),
                      F.count_if(outside).alias("outside_bound"))


@register("data_exfiltration", _with(fx.NET_SQL, PAIRS_CTE) + EXFIL_SELECT)
def q_data_exfiltration(spark, sf):
    return detect.data_exfiltration(fx.net(spark, sf, hosts=False))


@register("pair_activity", _with(fx.NET_SQL, PAIRS_CTE) + PORT_SCAN_SELECT + "\nUNION ALL" + EXFIL_SELECT)
def q_pair_activity(spark, sf):
    return detect.pair_activity(fx.net(spark, sf, hosts=False))


@register("ioc_match_key", _with(fx.IOCS_SQL, KEYS_CTE) + (
    "SELECT ioc, ioc_type, reporter, confidence_level, " + sql_text("tags") + " AS tags, is_compromised, ioc_for_match FROM keys"))
def q_ioc_match_key(spark, sf):
    return with_match_key(fx.iocs(spark, sf))


@register("ioc_candidates", _with(fx.NET_SQL, """
ev AS (
  SELECT DISTINCT uid, ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, query,
         unnest(CASE WHEN answers IS NULL OR len(answers) = 0 THEN [NULL::VARCHAR] ELSE answers END) AS answer, host
  FROM net
)""", CANDIDATES_CTE) + "SELECT * FROM cand")
def q_ioc_candidates(spark, sf):
    return detect.ioc_candidates(fx.net(spark, sf), dedup=True)


@register("ioc_match", _with(fx.NET_SQL, fx.IOCS_SQL, KEYS_CTE, EVENTS_CTE, CANDIDATES_CTE) + IOC_MATCH_SELECT)
def q_ioc_match(spark, sf):
    return detect.ioc_match(fx.net(spark, sf), fx.iocs(spark, sf))


@register("alerts_union", _with(fx.NET_SQL, fx.IOCS_SQL, KEYS_CTE, EVENTS_CTE, CANDIDATES_CTE, PAIRS_CTE)
          + IOC_MATCH_SELECT + "\nUNION ALL" + PORT_SCAN_SELECT + "\nUNION ALL" + EXFIL_SELECT)
def q_alerts_union(spark, sf):
    return detect.alerts(fx.net(spark, sf), fx.iocs(spark, sf))


# --------------------------------------------------------- indicator table




# Landing days up to MARKER form the initial table; later days the increment.
MARKER = _dt.date(2024, 1, 2)
MARKER_SQL = "DATE '2024-01-02'"
_CLEAN_NAMES = [f.name for f in CLEAN_IOC_SCHEMA.fields]
_PICK = [n for n in _CLEAN_NAMES if n not in ("id", "first_seen")]


def _entries(spark, sf):
    docs = fx.raw_documents(spark, sf)
    return ops.explode_raw(docs).withColumn("folder_date", F.make_date("year", "month", "day"))


def _clean_all(spark, sf):
    return ops.clean_iocs(_entries(spark, sf), keep=("folder_date",))


def _current(spark, sf):
    return ops.merge_iocs(None, _clean_all(spark, sf).filter(F.col("folder_date") <= F.lit(MARKER)))


def _increment(spark, sf):
    return _clean_all(spark, sf).filter(F.col("folder_date") > F.lit(MARKER))


def _feed_time_sql(expr: str) -> str:
    return f"try_strptime(trim(regexp_replace({expr}, 'UTC', '', 'g')), '%Y-%m-%d %H:%M:%S') + INTERVAL 3 HOUR"


_ENTRY_SQL = ("id, ioc, threat_type, ioc_type, malware, malware_printable, confidence_level, first_seen, last_seen, "
              "reference, reporter, " + sql_text("tags") + " AS tags, is_compromised, extra")
_YMD_SQL = ("CAST(year(folder_date) AS INTEGER) AS year, CAST(month(folder_date) AS INTEGER) AS month, "
            "CAST(day(folder_date) AS INTEGER) AS day")

CLEAN_CTE = f"""
clean AS (
  SELECT sha256(ioc) AS id, ioc, threat_type, ioc_type, malware, malware_printable,
         TRY_CAST(trunc(TRY_CAST(confidence_level AS DOUBLE)) AS INTEGER) AS confidence_level,
         {_feed_time_sql('first_seen')} AS first_seen,
         {_feed_time_sql('coalesce(last_seen, first_seen)')} AS last_seen,
         nullif(reference, '') AS reference, nullif(reporter, 'anonymous') AS reporter,
         tags, is_compromised, extra, folder_date
  FROM raw_iocs WHERE ioc IS NOT NULL
)"""


def _fold_sql(src: str) -> str:
    order = "_src, " + ", ".join(f"{c} ASC NULLS FIRST" for c in ["first_seen"] + _PICK)
    cols = ", ".join("_mx AS last_seen" if c == "last_seen" else c for c in _CLEAN_NAMES)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS _rn, "
            f"max(last_seen) OVER (PARTITION BY id) AS _mx FROM ({src})) WHERE _rn = 1")


_CLEAN_COLS_SQL = ", ".join(_CLEAN_NAMES)
_CLEAN_OUT_SQL = ", ".join(sql_text(c) + " AS tags" if c == "tags" else c for c in _CLEAN_NAMES)
CUR_CTE = f"cur AS ({_fold_sql(f'SELECT {_CLEAN_COLS_SQL}, 0 AS _src FROM clean WHERE folder_date <= {MARKER_SQL}')})"
INC_CTE = f"inc AS (SELECT * FROM clean WHERE folder_date > {MARKER_SQL})"
MERGE_SQL = _with(fx.RAW_IOCS_SQL, CLEAN_CTE, CUR_CTE, INC_CTE) + f"SELECT {_CLEAN_OUT_SQL} FROM (" + _fold_sql(
    f"SELECT {_CLEAN_COLS_SQL}, 0 AS _src FROM cur UNION ALL SELECT {_CLEAN_COLS_SQL}, 1 AS _src FROM inc") + ")"


@register("raw_explode", _with(fx.RAW_IOCS_SQL) + f"SELECT {_ENTRY_SQL}, {_YMD_SQL} FROM raw_iocs")
def q_raw_explode(spark, sf):
    """Raw feed documents -> one row per indicator."""
    return ops.explode_raw(fx.raw_documents(spark, sf))


@register("raw_explode_typed", _with(fx.RAW_IOCS_SQL) + f"SELECT {_ENTRY_SQL}, {_YMD_SQL} FROM raw_iocs")
def q_raw_explode_typed(spark, sf):
    """The landed feed, each indicator parsed once into VARIANT values."""
    base = work_dir(spark, "raw")
    land_raw(fx.raw_documents(spark, sf), base)
    return ops.explode_raw_typed(read_raw(spark, base)).drop("folder_date")


@register("clean_iocs", _with(fx.RAW_IOCS_SQL, CLEAN_CTE) + f"SELECT {_CLEAN_OUT_SQL} FROM clean")
def q_clean_iocs(spark, sf):
    return ops.clean_iocs(_entries(spark, sf))


@register("ioc_incremental", _with(fx.RAW_IOCS_SQL) + (
    f"SELECT {_ENTRY_SQL}, {_YMD_SQL}, folder_date FROM raw_iocs WHERE folder_date > {MARKER_SQL}"))
def q_ioc_incremental(spark, sf):
    """Land the feed in the Hive layout, then read only days after the marker
    (partition-pruned scan)."""
    base = work_dir(spark, "raw")
    land_raw(fx.raw_documents(spark, sf), base)
    return ops.explode_raw(read_raw(spark, base, after=MARKER, inclusive=False))


@register("max_folder_date", _with(fx.RAW_IOCS_SQL) + (
    f"SELECT max(folder_date) AS max_folder_date FROM raw_iocs WHERE folder_date > {MARKER_SQL}"))
def q_max_folder_date(spark, sf):
    return _entries(spark, sf).filter(F.col("folder_date") > F.lit(MARKER)).agg(
        F.max("folder_date").alias("max_folder_date"))


@register("new_iocs", _with(fx.RAW_IOCS_SQL, CLEAN_CTE, CUR_CTE, INC_CTE) + (
    f"SELECT {_CLEAN_OUT_SQL} FROM ({_fold_sql(f'SELECT {_CLEAN_COLS_SQL}, 1 AS _src FROM inc')}) n "
    "WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.id = n.id)"))
def q_new_iocs(spark, sf):
    return ops.new_iocs(_current(spark, sf), _increment(spark, sf))


@register("refresh_last_seen", _with(fx.RAW_IOCS_SQL, CLEAN_CTE, CUR_CTE, INC_CTE) + "SELECT " + ", ".join(
    "greatest(cur.last_seen, l._inc) AS last_seen" if c == "last_seen" else
    (sql_text("cur.tags") + " AS tags" if c == "tags" else f"cur.{c}") for c in _CLEAN_NAMES
) + " FROM cur LEFT JOIN (SELECT id, max(last_seen) AS _inc FROM inc GROUP BY id) l ON cur.id = l.id")
def q_refresh_last_seen(spark, sf):
    return ops.refresh_last_seen(_current(spark, sf), _increment(spark, sf))


@register("merge_iocs", MERGE_SQL)
def q_merge_iocs(spark, sf):
    return ops.merge_iocs(_current(spark, sf), _increment(spark, sf), unique=True)


@register("ioc_refresh_job", MERGE_SQL)
def q_ioc_refresh_job(spark, sf):
    """The scheduled job end to end: land days up to the marker, refresh,
    land the later days, refresh again, refresh once more (which changes nothing); read
    the committed table."""
    raw, table = work_dir(spark, "raw"), work_dir(spark, "iocs")
    docs = fx.raw_documents(spark, sf)
    day = F.make_date("year", "month", "day")
    land_raw(docs.filter(day <= F.lit(MARKER)), raw)
    run_ioc_refresh(spark, raw, table)
    land_raw(docs.filter(day > F.lit(MARKER)), raw)
    run_ioc_refresh(spark, raw, table)
    run_ioc_refresh(spark, raw, table)
    return read_iocs(spark, table)


# The landing area as a file stream: day 2 lands first, days 3 and 4 next, and
# day 1 last, three days late. An id keeps the row of its first merge.
_LANDED_SQL = _with(fx.RAW_IOCS_SQL, CLEAN_CTE) + f"SELECT {_CLEAN_OUT_SQL} FROM (" + _fold_sql(
    f"SELECT {_CLEAN_COLS_SQL}, CASE day(folder_date) WHEN 2 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS _src FROM clean") + ")"


@register("ioc_landing_stream", _LANDED_SQL)
def q_ioc_landing_stream(spark, sf):
    """The refresh that follows files: each run merges the files that landed
    since, whatever day they belong to, and rewrites only the buckets that
    change; a run without new files commits nothing."""
    raw, table = work_dir(spark, "raw"), work_dir(spark, "iocs")
    docs = fx.raw_documents(spark, sf)
    for days in ((2,), (3, 4), (1,), ()):
        if days:
            land_raw(docs.filter(F.col("day").isin(*days)), raw)
        follow_landing(spark, raw, table)
    return read_iocs(spark, table)


# --------------------------------------------------------- dedup, documents


_ALERTS_SQL = (_with(fx.NET_SQL, fx.IOCS_SQL, KEYS_CTE, EVENTS_CTE, CANDIDATES_CTE, PAIRS_CTE)
               + IOC_MATCH_SELECT + "\nUNION ALL" + PORT_SCAN_SELECT + "\nUNION ALL" + EXFIL_SELECT)


@register("dedup_events", _with(fx.NET_SQL, """
ev AS (
  SELECT uid, ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, query,
         unnest(CASE WHEN answers IS NULL OR len(answers) = 0 THEN [NULL::VARCHAR] ELSE answers END) AS answer, host
  FROM (SELECT * FROM net UNION ALL SELECT * FROM net)
)""") + "SELECT DISTINCT * FROM ev")
def q_dedup_events(spark, sf):
    """Every record delivered twice; the dedup step keeps one."""
    n = fx.net(spark, sf)
    return detect.ioc_events(n.unionByName(n), dedup=True)


@register("alert_json_roundtrip", _ALERTS_SQL)
def q_alert_json_roundtrip(spark, sf):
    """Alerts -> JSON records (null fields left out) -> typed alerts again."""
    a = detect.alerts(fx.net(spark, sf), fx.iocs(spark, sf))
    return decode_alerts(alert_json(a))


@register("alert_documents", "SELECT alert_id AS doc_id, * FROM (" + _ALERTS_SQL + ")")
def q_alert_documents(spark, sf):
    return alert_documents(detect.alerts(fx.net(spark, sf), fx.iocs(spark, sf)))


_JSON_SQL = "concat_ws(',', " + ", ".join(
    f"'\"{n}\":' || {v}" for n, v in (
        ("@path", "to_json(log_path)"), ("ts", "CAST(epoch_us(ts) AS VARCHAR)"), ("uid", "to_json(uid)"), ("id_orig_h", "to_json(id_orig_h)"),
        ("id_resp_h", "to_json(id_resp_h)"), ("id_resp_p", "CAST(id_resp_p AS VARCHAR)"), ("orig_bytes", "CAST(orig_bytes AS VARCHAR)"),
        ("host", "to_json(host)"), ("query", "to_json(query)"), ("answers", "to_json(answers)"))) + ")"
_DOC_KEY_SQL = "sha256('{' || " + _JSON_SQL + " || '}')"


@register("log_documents", _with(fx.NET_SQL) + _wide_select_sql().replace("SELECT ", f"SELECT {_DOC_KEY_SQL} AS doc_id, ", 1))
def q_log_documents(spark, sf):
    return log_documents(fx.net(spark, sf))


def _ipv4_sql(c: str) -> str:
    parts = " + ".join(f"CAST(split_part({c}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
    return f"CASE WHEN regexp_full_match({c}, '(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})') THEN {parts} END"


def _segment_sql(c: str) -> str:
    """Segment of an address: 10.10.10.0/24, 10.20.20.0/24, 10.30.30.0/24."""
    return (f"CASE ({_ipv4_sql(c)}) // 256 WHEN 657930 THEN 'corp-users' WHEN 660500 THEN 'datacenter' "
            "WHEN 663070 THEN 'dmz' END")


@register("locality", _with(fx.NET_SQL) + (
    f"SELECT ts, uid, id_orig_h, id_resp_h, ({_segment_sql('id_orig_h')}) IS NOT NULL AS local_orig, "
    f"({_segment_sql('id_resp_h')}) IS NOT NULL AS local_resp, {_segment_sql('id_orig_h')} AS orig_segment FROM net"))
def q_locality(spark, sf):
    return enrich.with_locality(fx.net(spark, sf, hosts=False)).select(
        "ts", "uid", "id_orig_h", "id_resp_h", "local_orig", "local_resp",
        enrich.segment_of("id_orig_h").alias("orig_segment"))


@register("service_name", _with(fx.NET_SQL) + (
    "SELECT ts, uid, id_resp_p, CASE id_resp_p WHEN 21 THEN 'ftp' WHEN 22 THEN 'ssh' WHEN 25 THEN 'smtp' WHEN 53 THEN 'dns' "
    "WHEN 80 THEN 'http' WHEN 110 THEN 'pop3' WHEN 143 THEN 'imap' WHEN 443 THEN 'ssl' ELSE '-' END AS service FROM net"))
def q_service_name(spark, sf):
    return enrich.with_service(fx.net(spark, sf, hosts=False)).select("ts", "uid", "id_resp_p", "service")


# Status codes of the fixture's http rows: the known ten plus one unknown.
_FIXTURE_CODES = [200, 201, 204, 301, 302, 400, 401, 403, 404, 500, 418]


@register("status_message", _with(fx.NET_SQL) + (
    "SELECT ts, uid, code AS status_code, CASE code WHEN 200 THEN 'OK' WHEN 201 THEN 'Created' WHEN 204 THEN 'No Content' "
    "WHEN 301 THEN 'Moved Permanently' WHEN 302 THEN 'Found' WHEN 400 THEN 'Bad Request' WHEN 401 THEN 'Unauthorized' "
    "WHEN 403 THEN 'Forbidden' WHEN 404 THEN 'Not Found' WHEN 500 THEN 'Internal Server Error' END AS status_msg "
    f"FROM (SELECT ts, uid, {_FIXTURE_CODES}[id_resp_p % {len(_FIXTURE_CODES)} + 1] AS code FROM net WHERE log_path = 'http')"))
def q_status_message(spark, sf):
    n = fx.net(spark, sf, hosts=False).filter(F.col("log_path") == "http")
    codes = F.array(*[F.lit(c) for c in _FIXTURE_CODES])
    n = n.withColumn("status_code", F.element_at(codes, (F.col("id_resp_p") % len(_FIXTURE_CODES) + 1).cast("int")))
    return enrich.with_status_message(n).select("ts", "uid", "status_code", "status_msg")


# ---------------------------------------------------------------- streaming


_IOC_MATCH_SQL = _with(fx.NET_SQL, fx.IOCS_SQL, KEYS_CTE, EVENTS_CTE, CANDIDATES_CTE) + IOC_MATCH_SELECT
_PAIRS_SQL = _with(fx.NET_SQL, PAIRS_CTE) + PORT_SCAN_SELECT + "\nUNION ALL" + EXFIL_SELECT


@register("stream_alerts", _ALERTS_SQL)
def q_stream_alerts(spark, sf):
    """The streaming job (sensor JSON files -> decode -> watermark -> three
    detectors -> file sink), replayed over the whole table."""
    return replay_alerts(spark, fx.net(spark, sf), fx.iocs(spark, sf))


@register("stream_ioc_match", _IOC_MATCH_SQL)
def q_stream_ioc_match(spark, sf):
    return replay_alerts(spark, fx.net(spark, sf), fx.iocs(spark, sf), detectors=("ioc",))


@register("stream_pair_activity", _PAIRS_SQL)
def q_stream_pair_activity(spark, sf):
    return replay_alerts(spark, fx.net(spark, sf, hosts=False), None, detectors=("scan", "exfil"))


# ------------------------------------------------------ strict match keys


_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?(?:\[([^\]]+)\]|([^/:?#]+))"
_V6 = r"^\[([^\]]+)\]"


def _normal_sql(c: str) -> str:
    """Lower case, trimmed, no port, no IPv6 brackets."""
    v = f"lower(trim({c}))"
    return (f"CASE WHEN regexp_matches({v}, '^\\[[^\\]]+\\](:[0-9]+)?$') THEN regexp_extract({v}, '{_V6}', 1) "
            f"WHEN regexp_matches({v}, '^[^:]+:[0-9]+$') THEN split_part({v}, ':', 1) ELSE {v} END")


_STRICT_KEY_SQL = (
    f"CASE WHEN ioc_type = 'ip:port' THEN CASE WHEN regexp_extract(ioc, '{_V6}', 1) <> '' "
    f"THEN lower(regexp_extract(ioc, '{_V6}', 1)) ELSE split_part(ioc, ':', 1) END "
    f"WHEN ioc_type = 'url' THEN lower(CASE WHEN regexp_extract(ioc, '{_HOST}', 1) <> '' "
    f"THEN regexp_extract(ioc, '{_HOST}', 1) ELSE regexp_extract(ioc, '{_HOST}', 2) END) "
    f"ELSE {_normal_sql('ioc')} END AS ioc_for_match")


@register("ioc_match_key_strict", _with(fx.IOCS_SQL) + (
    "SELECT ioc, ioc_type, reporter, confidence_level, " + sql_text("tags") + f" AS tags, is_compromised, {_STRICT_KEY_SQL} FROM iocs"))
def q_ioc_match_key_strict(spark, sf):
    """The stricter key rule (case, user info, port, IPv6 brackets)."""
    return with_match_key(fx.iocs(spark, sf), strict=True)


@register("ioc_match_strict", _with(fx.NET_UNTIDY_SQL, fx.IOCS_SQL, f"keys AS (SELECT {_STRICT_KEY_SQL}, * FROM iocs)", EVENTS_CTE,
          CANDIDATES_CTE.replace("cand AS (", "raw_cand AS ("),
          f"cand AS (SELECT * REPLACE ({_normal_sql('match_value')} AS match_value) FROM raw_cand)") + IOC_MATCH_SELECT)
def q_ioc_match_strict(spark, sf):
    """Strict matching of logs with upper-case names, ports and bracketed IPv6."""
    return detect.ioc_match(fx.net_untidy(spark, sf), fx.iocs(spark, sf), strict_keys=True)


@register("stream_alerts_multibatch", _ALERTS_SQL)
def q_stream_alerts_multibatch(spark, sf):
    """One stream over five event-time files, a file per micro-batch."""
    return replay_alerts(spark, fx.net(spark, sf), fx.iocs(spark, sf), slices=5)


@register("stream_alerts_resumed", _ALERTS_SQL)
def q_stream_alerts_resumed(spark, sf):
    """The whole table in three event-time slices, the stream restarted on
    one checkpoint per slice: state and watermark must carry over."""
    return replay_alerts(spark, fx.net(spark, sf), fx.iocs(spark, sf), slices=3, restart=True)


@register("stream_port_scan", _with(fx.NET_SQL, PAIRS_CTE) + PORT_SCAN_SELECT)
def q_stream_port_scan(spark, sf):
    return replay_alerts(spark, fx.net(spark, sf, hosts=False), None, detectors=("scan",))


@register("stream_exfil", _with(fx.NET_SQL, PAIRS_CTE) + EXFIL_SELECT)
def q_stream_exfil(spark, sf):
    return replay_alerts(spark, fx.net(spark, sf, hosts=False), None, detectors=("exfil",))


@register("stream_dedup_events", _with(fx.NET_SQL, """
ev AS (
  SELECT uid, ts, id_orig_h AS orig_ip, id_resp_h AS resp_ip, query,
         unnest(CASE WHEN answers IS NULL OR len(answers) = 0 THEN [NULL::VARCHAR] ELSE answers END) AS answer, host
  FROM (SELECT * FROM net UNION ALL SELECT * FROM net)
)""") + "SELECT DISTINCT * FROM ev")
def q_stream_dedup_events(spark, sf):
    """Every record delivered twice on the stream; dedup within the
    watermark keeps one."""
    from tidewatch.sources.logs import DETECTOR_FIELDS, with_event_time

    n = fx.net(spark, sf)
    return replay_through(spark, n.unionByName(n), lambda recs: detect.ioc_events(
        with_event_time(decode_logs(recs, fields=DETECTOR_FIELDS)), dedup=True))


@register("stream_log_documents", _with(fx.NET_SQL) + "SELECT DISTINCT * FROM (" + _wide_select_sql().replace(
    "SELECT ", f"SELECT {_DOC_KEY_SQL} AS doc_id, ", 1) + ") UNION ALL BY NAME SELECT sha256('text:' || 'not json ' || region.r_name) AS doc_id, "
    "'not json ' || region.r_name AS raw_text FROM region")
def q_stream_log_documents(spark, sf):
    """The log-document copy stream over every record delivered twice, with
    some undecodable text between: each document once."""
    records = encode_logs(fx.net(spark, sf))
    broken = fx.table(spark, sf, "region").select(F.concat(F.lit("not json "), "r_name").alias("value"))
    return replay_documents(spark, records.unionByName(records).unionByName(broken).unionByName(broken), "logs")


@register("stream_alert_documents", "SELECT alert_id AS doc_id, * FROM (" + _ALERTS_SQL + ")")
def q_stream_alert_documents(spark, sf):
    """The alert-document copy stream over every alert record delivered twice."""
    records = alert_json(detect.alerts(fx.net(spark, sf), fx.iocs(spark, sf))).select("value")
    return replay_documents(spark, records.unionByName(records), "alerts")


@register("stream_log_upserts", REGISTRY["stream_log_documents"].sql)
def q_stream_log_upserts(spark, sf):
    """The keyed copy of log records, every record delivered again by a later
    run, and the last micro-batch repeated: each document is stored once."""
    records = encode_logs(fx.net(spark, sf))
    broken = fx.table(spark, sf, "region").select(F.concat(F.lit("not json "), "r_name").alias("value"))
    delivery = records.unionByName(broken)
    return replay_upserts(spark, [delivery, delivery.unionByName(delivery)], "logs")


@register("stream_alert_upserts", "SELECT alert_id AS doc_id, * FROM (" + _ALERTS_SQL + ")")
def q_stream_alert_upserts(spark, sf):
    """The keyed copy of alerts, computed again (with another processing time)
    and delivered again by a later run."""
    logs, iocs = fx.net(spark, sf), fx.iocs(spark, sf)
    at = [alert_json(detect.alerts(logs, iocs, alert_ts=F.lit(f"2024-02-0{day}").cast("timestamp"))) for day in (1, 2)]
    return replay_upserts(spark, at, "alerts")


@register("alerts_one_scan", _ALERTS_SQL)
def q_alerts_one_scan(spark, sf):
    """All detectors from one read of the logs and one aggregation."""
    return detect.alerts_one_scan(fx.net(spark, sf), fx.iocs(spark, sf))


@register("stream_alerts_one_scan", _ALERTS_SQL)
def q_stream_alerts_one_scan(spark, sf):
    """The same as a stream with one state store, restarted between three
    event-time slices."""
    return replay_alerts(spark, fx.net(spark, sf), fx.iocs(spark, sf), slices=3, restart=True, one_scan=True)


LATE_HOST = "10.10.10.3"
_LATE_SQL = _with(fx.NET_SQL.replace("net AS (", "whole AS ("), f"net AS (SELECT * FROM whole WHERE id_orig_h = '{LATE_HOST}')", fx.IOCS_SQL,
                  KEYS_CTE, EVENTS_CTE, CANDIDATES_CTE, PAIRS_CTE, fx.RAW_IOCS_SQL)


@register("dropped_counts", _LATE_SQL + f"""
SELECT 'late_groups' AS cause, (SELECT count(*) FROM pairs) + (SELECT count(*) FROM ({IOC_MATCH_SELECT})) AS n
UNION ALL SELECT 'undecodable', count(*) FROM region
UNION ALL SELECT 'untimed', count(*) FROM whole WHERE id_resp_p = 7
UNION ALL SELECT 'records', (SELECT count(*) FROM region) + (SELECT count(*) FROM whole WHERE id_resp_p = 7) + (SELECT count(*) FROM whole)
                            + (SELECT count(*) FROM net) + 2
UNION ALL SELECT 'indicators_without_ioc', count(*) FROM raw_iocs WHERE ioc IS NULL""")
def q_dropped_counts(spark, sf):
    """What the jobs drop, by cause: all records with some that do not decode or
    have no time; records that close all windows; one host's records again, all
    of them behind the watermark; and the indicator feed."""
    logs = fx.net(spark, sf)
    broken = fx.table(spark, sf, "region").select(F.concat(F.lit("not json "), "r_name").alias("value"))
    untimed = encode_logs(logs.where("id_resp_p = 7").withColumn("ts", F.lit(None).cast("timestamp")))
    folder = work_dir(spark, "closing")
    last = event_bounds(logs)["hi"]
    for i in (1, 2):  # rows are dropped against the watermark of the micro-batch before
        write_closing(spark, f"{folder}/{i}", last + _dt.timedelta(minutes=i) if last else None)
    closing = [spark.read.text(f"{folder}/{i}") for i in (1, 2)] if last else []
    late = encode_logs(logs.where(F.col("id_orig_h") == LATE_HOST))
    counts = replay_drops(spark, [encode_logs(logs).unionByName(broken).unionByName(untimed), *closing, late], fx.iocs(spark, sf))
    raw, table = work_dir(spark, "raw"), work_dir(spark, "iocs")
    land_raw(fx.raw_documents(spark, sf), raw)
    counts["indicators_without_ioc"] = follow_landing(spark, raw, table).without_ioc
    return spark.createDataFrame(sorted(counts.items()), "cause string, n long")


@register("ioc_match_prefiltered", _IOC_MATCH_SQL)
def q_ioc_match_prefiltered(spark, sf):
    """Indicators taken as too many to broadcast: values that no key's bit
    matches are dropped before the salted shuffle."""
    return detect.ioc_match(fx.net(spark, sf), fx.iocs(spark, sf), broadcast_limit=0, prefilter=True)


_SEGMENT_LOOKUP_SQL = _with(fx.NET_SQL, fx.SEGMENTS_SQL, """
m4 AS (SELECT v4, first(name ORDER BY len DESC, name) AS orig_segment FROM (SELECT DISTINCT v4 FROM dual) JOIN seg4 ON v4 >> (32 - len) = net >> (32 - len) GROUP BY v4),
m6 AS (SELECT v6, first(name ORDER BY len DESC, name) AS v6_segment FROM (SELECT DISTINCT v6 FROM dual) JOIN seg6 ON left(v6, len // 4) = left(net, len // 4) GROUP BY v6)""") + (
    "SELECT ts, uid, id_orig_h, orig_v6, orig_segment, v6_segment FROM dual LEFT JOIN m4 USING (v4) LEFT JOIN m6 USING (v6)")


@register("segment_lookup", _SEGMENT_LOOKUP_SQL)
def q_segment_lookup(spark, sf):
    """Longest-prefix match of IPv4 and IPv6 sources in one table of segments."""
    segments = fx.segments(spark, sf)
    named = with_segment(fx.dual_stack(spark, sf), "id_orig_h", segments, "orig_segment")
    return with_segment(named, "orig_v6", segments, "v6_segment")


@register("segment_lookup_large", _SEGMENT_LOOKUP_SQL)
def q_segment_lookup_large(spark, sf):
    """The same with a table taken as too large to broadcast."""
    segments = fx.segments(spark, sf)
    named = with_segment(fx.dual_stack(spark, sf), "id_orig_h", segments, "orig_segment", limit=0)
    return with_segment(named, "orig_v6", segments, "v6_segment", limit=0)


_SKETCH_LEVELS = (("10 minutes", ("id_orig_h",), 600), ("1 hour", ("id_orig_h",), 3600), ("1 hour", ("id_orig_h", "id_resp_h"), 3600))


@register("port_sketches", _with(fx.NET_SQL) + "\nUNION ALL ".join(
    f"SELECT '{w} {len(keys)}' AS level, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_ports, CAST(0 AS BIGINT) AS outside_bound "
    f"FROM (SELECT count(DISTINCT id_resp_p) AS n FROM net WHERE ts IS NOT NULL GROUP BY {_bucket(sec)}, {', '.join(keys)})" for w, keys, sec in _SKETCH_LEVELS))
def q_port_sketches(spark, sf):
    """One sketch a (minute, source, destination), merged to longer windows and
    to one source over all destinations; each estimate against the exact count."""
    n = fx.net(spark, sf, hosts=False)
    stored = sketches.port_sketches(n)
    out = None
    for w, keys, _ in _SKETCH_LEVELS:
        exact = n.groupBy(F.window("ts", w).alias("window"), *keys).agg(F.count_distinct("id_resp_p").alias("exact"))
        both = sketches.with_estimate(sketches.merged(stored, w, keys)).select("window", *keys, "port_count").join(exact, ["window", *keys])
        outside = F.abs(F.col("port_count") - F.col("exact")) > sketches.error_bound(F.col("exact"))
        one = both.agg(F.count(F.lit(1)).alias("n_groups"), F.sum("exact").cast("long").alias("n_ports"), F.count_if(outside).alias("outside_bound"))
        one = one.select(F.lit(f"{w} {len(keys)}").alias("level"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# Alerts that the approximate count must raise, whatever its error within four
# standard deviations: groups whose exact count lies beyond the band at 8 ports.
@register("port_scan_approx_alerts", _with(fx.NET_SQL, PAIRS_CTE) + (
    f"SELECT {_id('Port Scanning', 'id_orig_h', 'id_resp_h')} AS alert_id, 'Port Scanning' AS alert_type, event_ts, id_orig_h AS orig_ip, "
    "id_resp_h AS resp_ip, CAST(port_count AS BIGINT) AS exact FROM pairs WHERE port_count > (8 + 1) / (1 - 0.2)"))
def q_port_scan_approx_alerts(spark, sf):
    """Approximate port-scan alerts, without those whose exact count lies inside
    the error band of the threshold."""
    n = fx.net(spark, sf, hosts=False)
    exact = n.groupBy(F.window("ts", detect.DEFAULT.pair_window).alias("window"), "id_orig_h", "id_resp_h").agg(detect.port_count().cast("long").alias("exact"))
    ids = exact.select(alert_id(detect.PORT_SCAN, "window", "id_orig_h", "id_resp_h").alias("alert_id"), "exact")
    found = detect.port_scan(n, exact=False).join(ids, "alert_id")
    inside = (F.col("exact") <= (8 + 1) / (1 - 0.2)) & (F.col("exact") >= (8 - 1) / (1 + 0.2))
    return found.where(~inside).select("alert_id", "alert_type", "event_ts", "orig_ip", "resp_ip", "exact")

"""Adapter views that turn the driver's test tables into sensor-shaped data.

`net` is one wide log row per `events` row (conn/dns/http in turn, 50 ms
apart); `raw_iocs` is one raw indicator per `pages` row spread over four
feed days, with the dirt a feed has; `iocs` is a clean indicator table from
all page hosts covering all three match-key rules. Each view has a Spark builder and the same definition as DuckDB SQL
(used by the oracles), so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import url_host
from tidewatch.functions.sizing import broadcast_if_small

# Fixed values of the adapters.
EPOCH_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC, start of the timeline
STEP_MS = 50  # one event every 50 ms
RESP_NET = "203.0.113."
ORIG_NET = "10.10.10."
RESOLVER_ANSWER = "198.51.100.7"
EVENT_HOST = {"click": 1, "view": 2, "purchase": 3, "signup": 4}  # else 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url_host("url").alias("page_host"))


def net(spark: SparkSession, sf_dir: str, hosts: bool = True) -> DataFrame:
    """Wide network-log rows (flat names) built from `events` and `pages`.
    `hosts=False` leaves `query` and `host` null and does not read `pages`."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    kind = F.col("event_id") % 3
    resp_octet = F.coalesce(
        *[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_HOST.items()], F.lit(5)
    )
    resp_ip = F.concat(F.lit(RESP_NET), resp_octet.cast("string"))
    if hosts:
        named, size = broadcast_if_small(page_hosts(spark, sf_dir))
        key = (F.col("event_id") % F.lit(size.rows)) if size.rows else F.lit(None).cast("long")
        ev = ev.withColumn("page_key", key)
        ev = ev.join(named, ev["page_key"] == named["page_id"], "left")
    else:
        ev = ev.withColumn("page_host", F.lit(None).cast("string"))
    return ev.select(
        F.timestamp_millis(F.lit(EPOCH_MS) + F.col("event_id") * STEP_MS).alias("ts"),
        F.concat(F.lit("C"), F.expr("event_id div 3").cast("string")).alias("uid"),
        F.when(kind == 0, "conn").when(kind == 1, "dns").otherwise("http").alias("log_path"),
        F.concat(F.lit(ORIG_NET), (F.col("user_id") % 20 + 1).cast("int").cast("string")).alias("id_orig_h"),
        resp_ip.alias("id_resp_h"),
        F.get_json_object("props", "$.k").try_cast("int").alias("id_resp_p"),
        F.when(kind == 0, F.floor(F.col("value") * 500000).cast("long")).alias("orig_bytes"),
        F.when(kind == 1, F.col("page_host")).alias("query"),
        F.when(kind == 1, F.array(resp_ip, F.lit(RESOLVER_ANSWER))).alias("answers"),
        F.when(kind == 2, F.col("page_host")).alias("host"),
    )


def net_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`net` as careless sensors write it: names in upper case, hosts with a
    port, a bracketed IPv6 answer."""
    return net(spark, sf_dir).withColumns({
        "query": F.upper("query"),
        "host": F.concat("host", F.lit(":8080")),
        "answers": F.when(F.col("answers").isNotNull(), F.concat("answers", F.array(F.lit("[2001:DB8::7]:53")))),
    })


def raw_iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat raw indicators (feed text fields) with their landing day. Some
    have no `ioc`, unreadable times, a confidence that is no number, tags, or
    fields of their own (`asn`, `note`)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    n = F.col("page_id")
    day = (n % 4 + 1).cast("int")
    day_text = F.concat(F.lit("2024-01-0"), day.cast("string"))
    return p.select(
        n.cast("string").alias("id"),
        F.when(n % 23 != 0, url_host("url")).alias("ioc"),
        F.when(n % 4 == 0, F.lit("botnet")).alias("threat_type"),
        F.lit("domain").alias("ioc_type"),
        F.when(n % 6 == 0, F.concat(F.lit("fam."), (n % 3).cast("string"))).alias("malware"),
        F.when(n % 7 == 0, F.lit("anonymous"))
        .otherwise(F.concat(F.lit("rep"), (n % 5).cast("string"))).alias("reporter"),
        F.when(n % 17 == 0, F.lit("soon")).otherwise(F.concat(day_text, F.lit(" 10:00:00 UTC"))).alias("first_seen"),
        F.when(n % 3 == 0, F.concat(day_text, F.lit(" 11:00:00 UTC"))).alias("last_seen"),
        F.when(n % 5 == 0, F.lit("")).otherwise(F.col("url")).alias("reference"),
        F.when(n % 13 == 0, F.lit("high")).when(n % 11 == 0, F.concat((n % 100).cast("string"), F.lit(".9")))
        .otherwise((n % 100).cast("string")).alias("confidence_level"),
        F.when(n % 2 == 0, F.array(F.lit("c2"), F.concat(F.lit("t"), (n % 9).cast("string")))).alias("tags"),
        (n % 40 == 0).alias("is_compromised"),
        F.when(n % 8 == 0, F.concat(F.lit("AS"), n.cast("string"))).alias("asn"),
        F.when(n % 16 == 0, F.lit("seen twice")).alias("note"),
        F.make_date(F.lit(2024), F.lit(1), day).alias("folder_date"),
        n,
    )


# Indicators per raw feed document; a pull carries a bounded list.
DOCUMENT_SIZE = 100


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed documents `{query_status, data: [...]}` with year/month/day.

    Indicators of one day are packed `DOCUMENT_SIZE` to a document, so no
    document (and no group) grows with the table. Every day also has a
    document without indicators.
    """
    from tidewatch.schemas import RAW_IOC_ENTRY

    flat = raw_iocs(spark, sf_dir)
    entry = F.struct(*[
        (F.col(f.name) if f.name in flat.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RAW_IOC_ENTRY.fields
    ], "asn", "note")
    seq = F.expr(f"page_id div {4 * DOCUMENT_SIZE}")
    full = (
        flat.groupBy("folder_date", seq.alias("doc"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("page_id"), entry.alias("e")))).alias("items"))
        .select(
            F.lit("ok").alias("query_status"),
            F.transform("items", lambda x: x["e"]).alias("data"),
            F.year("folder_date").alias("year"),
            F.month("folder_date").alias("month"),
            F.dayofmonth("folder_date").alias("day"),
        )
    )
    none = full.select("year", "month", "day").distinct().select(
        F.lit("no_result").alias("query_status"), F.lit(None).cast(full.schema["data"].dataType).alias("data"), "year", "month", "day")
    return full.unionByName(none)


def iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-side indicator table: one URL indicator per distinct page host
    (that of its first page) plus feed rows for the `ip:port` and plain rules."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    p = p.groupBy(url_host("url").alias("page_host")).agg(F.min(F.struct("page_id", "url")).alias("p")).select("p.*")
    from_pages = p.select(
        F.col("url").alias("ioc"),
        F.lit("url").alias("ioc_type"),
        F.when(F.col("page_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("rep"), (F.col("page_id") % 5).cast("string"))).alias("reporter"),
        (F.col("page_id") % 100).cast("int").alias("confidence_level"),
        F.when(F.col("page_id") % 60 == 0, F.lit(None).cast(T.ArrayType(T.StringType())))
        .otherwise(F.array(F.lit("pages"), F.concat(F.lit("t"), (F.col("page_id") % 3).cast("string")))).alias("tags"),
        (F.col("page_id") % 40 == 0).alias("is_compromised"),
    )
    feed = spark.createDataFrame(
        [("203.0.113.3:443", "ip:port", "rep9", 90, ["feed"], False),
         ("[2001:db8::7]:443", "ip:port", "rep9", 91, ["feed", "v6"], False),
         (RESOLVER_ANSWER, "ip", "rep8", 55, ["feed"], None)],
        "ioc string, ioc_type string, reporter string, confidence_level int, tags array<string>, is_compromised boolean",
    )
    return from_pages.unionByName(feed)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping network segments of both families, from `nation` and
    `region`: nested IPv4 segments of /8 to /31 around the log sources, IPv6
    ones of /20 to /64, some of them the same after masking, and two rows whose
    CIDR is none."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    k, j = F.col("n_nationkey"), F.col("r_regionkey")
    text = lambda c: c.cast("int").cast("string")
    parts = [
        n.select(F.col("n_name").alias("name"), F.concat(F.lit(ORIG_NET), text(k * 8), F.lit("/"), text(k % 5 + 27)).alias("cidr")),
        r.select(F.col("r_name").alias("name"), F.concat(F.lit("10.10.0.0/"), text(j * 2 + 8)).alias("cidr")),
        n.select(F.col("n_name").alias("name"), F.concat(F.lit("2001:db8:"), F.lower(F.hex(k.cast("long"))), F.lit("::/"), text(k % 8 * 4 + 36)).alias("cidr")),
        r.select(F.col("r_name").alias("name"), F.concat(F.lit("2001:DB8::/"), text(j * 4 + 20)).alias("cidr")),
        r.where("r_regionkey < 2").select(F.col("r_name").alias("name"), F.when(j == 0, F.lit("10.10.10.0/40")).alias("cidr")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dual_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, uid, id_orig_h, orig_v6): the log sources, each with an IPv6 address too."""
    port = F.col("id_resp_p").cast("long")
    return net(spark, sf_dir, hosts=False).select("ts", "uid", "id_orig_h", F.concat(
        F.lit("2001:DB8:"), F.hex(port % 32), F.lit("::"), F.hex(port)).alias("orig_v6"))


# ---------------------------------------------------------------- DuckDB SQL

NET_SQL = f"""
net AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(e.event_id * {STEP_MS}) AS ts,
         'C' || CAST(e.event_id // 3 AS VARCHAR) AS uid,
         CASE e.event_id % 3 WHEN 0 THEN 'conn' WHEN 1 THEN 'dns' ELSE 'http' END AS log_path,
         '{ORIG_NET}' || CAST(CAST(e.user_id % 20 + 1 AS INT) AS VARCHAR) AS id_orig_h,
         '{RESP_NET}' || CAST(CASE e.event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2
              WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS VARCHAR) AS id_resp_h,
         TRY_CAST(json_extract_string(e.props, '$.k') AS INT) AS id_resp_p,
         CASE WHEN e.event_id % 3 = 0 THEN CAST(floor(e.value * 500000) AS BIGINT) END AS orig_bytes,
         CASE WHEN e.event_id % 3 = 1 THEN h.page_host END AS query,
         CASE WHEN e.event_id % 3 = 1 THEN ['{RESP_NET}' || CAST(CASE e.event_type WHEN 'click' THEN 1
              WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS VARCHAR),
              '{RESOLVER_ANSWER}'] END AS answers,
         CASE WHEN e.event_id % 3 = 2 THEN h.page_host END AS host
  FROM events e
  LEFT JOIN (SELECT page_id, regexp_extract(url, '(?:https?://)?([^/]+)', 1) AS page_host FROM pages) h
    ON e.event_id % (SELECT count(*) FROM pages) = h.page_id
)"""

NET_UNTIDY_SQL = NET_SQL.replace("net AS (", "tidy AS (") + """,
net AS (
  SELECT ts, uid, log_path, id_orig_h, id_resp_h, id_resp_p, orig_bytes, upper(query) AS query,
         CASE WHEN answers IS NOT NULL THEN list_append(answers, '[2001:DB8::7]:53') END AS answers,
         host || ':8080' AS host
  FROM tidy
)"""

RAW_IOCS_SQL = """
raw_iocs AS (
  SELECT CAST(page_id AS VARCHAR) AS id,
         CASE WHEN page_id % 23 <> 0 THEN regexp_extract(url, '(?:https?://)?([^/]+)', 1) END AS ioc,
         CASE WHEN page_id % 4 = 0 THEN 'botnet' END AS threat_type, 'domain' AS ioc_type,
         CASE WHEN page_id % 6 = 0 THEN 'fam.' || CAST(page_id % 3 AS VARCHAR) END AS malware,
         CAST(NULL AS VARCHAR) AS malware_printable,
         CASE WHEN page_id % 7 = 0 THEN 'anonymous' ELSE 'rep' || CAST(page_id % 5 AS VARCHAR) END AS reporter,
         CASE WHEN page_id % 17 = 0 THEN 'soon' ELSE '2024-01-0' || CAST(1 + page_id % 4 AS VARCHAR) || ' 10:00:00 UTC' END AS first_seen,
         CASE WHEN page_id % 3 = 0 THEN '2024-01-0' || CAST(1 + page_id % 4 AS VARCHAR) || ' 11:00:00 UTC' END AS last_seen,
         CASE WHEN page_id % 5 = 0 THEN '' ELSE url END AS reference,
         CASE WHEN page_id % 13 = 0 THEN 'high' WHEN page_id % 11 = 0 THEN CAST(page_id % 100 AS VARCHAR) || '.9'
              ELSE CAST(page_id % 100 AS VARCHAR) END AS confidence_level,
         CASE WHEN page_id % 2 = 0 THEN ['c2', 't' || CAST(page_id % 9 AS VARCHAR)] END AS tags,
         page_id % 40 = 0 AS is_compromised,
         CASE WHEN page_id % 16 = 0 THEN '{"asn":"AS' || CAST(page_id AS VARCHAR) || '","note":"seen twice"}'
              WHEN page_id % 8 = 0 THEN '{"asn":"AS' || CAST(page_id AS VARCHAR) || '"}' END AS extra,
         make_date(2024, 1, CAST(1 + page_id % 4 AS INT)) AS folder_date,
         page_id
  FROM pages
)"""

IOCS_SQL = """
iocs AS (
  SELECT url AS ioc, 'url' AS ioc_type,
         CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'rep' || CAST(page_id % 5 AS VARCHAR) END AS reporter,
         CAST(page_id % 100 AS INT) AS confidence_level,
         CASE WHEN page_id % 60 = 0 THEN NULL ELSE ['pages', 't' || CAST(page_id % 3 AS VARCHAR)] END AS tags,
         page_id % 40 = 0 AS is_compromised
  FROM (SELECT *, row_number() OVER (PARTITION BY regexp_extract(url, '(?:https?://)?([^/]+)', 1) ORDER BY page_id, url) AS k FROM pages)
  WHERE k = 1
  UNION ALL SELECT '203.0.113.3:443', 'ip:port', 'rep9', 90, ['feed'], false
  UNION ALL SELECT '[2001:db8::7]:443', 'ip:port', 'rep9', 91, ['feed', 'v6'], false
  UNION ALL SELECT '198.51.100.7', 'ip', 'rep8', 55, ['feed'], CAST(NULL AS BOOLEAN)
)"""

# The segments of `segments` as (name, family, network, length): IPv4 networks
# as numbers, IPv6 ones as 32 hexadecimal digits.
SEGMENTS_SQL = f"""
seg4 AS (
  SELECT n_name AS name, CAST(10 * 16777216 + 10 * 65536 + 10 * 256 + n_nationkey * 8 AS BIGINT) AS net, CAST(n_nationkey % 5 + 27 AS INT) AS len FROM nation
  UNION ALL SELECT r_name, CAST(10 * 16777216 + 10 * 65536 AS BIGINT), CAST(r_regionkey * 2 + 8 AS INT) FROM region
),
seg6 AS (
  SELECT n_name AS name, '20010db8' || lpad(lower(to_hex(CAST(n_nationkey AS BIGINT))), 4, '0') || repeat('0', 20) AS net, CAST(n_nationkey % 8 * 4 + 36 AS INT) AS len FROM nation
  UNION ALL SELECT r_name, '20010db8' || repeat('0', 24), CAST(r_regionkey * 4 + 20 AS INT) FROM region
),
dual AS (
  SELECT ts, uid, id_orig_h, '2001:DB8:' || to_hex(CAST(id_resp_p % 32 AS BIGINT)) || '::' || to_hex(CAST(id_resp_p AS BIGINT)) AS orig_v6,
         CAST(split_part(id_orig_h, '.', 4) AS BIGINT) + 10 * 16777216 + 10 * 65536 + 10 * 256 AS v4,
         '20010db8' || lpad(lower(to_hex(CAST(id_resp_p % 32 AS BIGINT))), 4, '0') || repeat('0', 16) || lpad(lower(to_hex(CAST(id_resp_p AS BIGINT))), 4, '0') AS v6
  FROM net
)"""

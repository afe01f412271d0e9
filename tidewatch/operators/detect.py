"""Detectors over wide network-log rows: port scan, data exfiltration and
indicator (IOC) match, plus the union into one typed alert stream.

Every detector is a function DataFrame -> DataFrame that runs unchanged on a
batch table and on a stream (the stream must carry a watermark on `ts`).
Output rows follow `ALERT_SCHEMA`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import alert_id, empty_strings, normal_value, sorted_set
from tidewatch.operators.iocs import MatchKeys, prepared_keys
from tidewatch.operators.prefilter import key_bitmap, likely_matches
from tidewatch.schemas import ALERT_SCHEMA

# Alert type names and severities.
PORT_SCAN = "Port Scanning"
EXFILTRATION = "Data Exfiltration"
IOC_MATCH = "IOC Match"
HIGH, MEDIUM = "High", "Medium"


@dataclass(frozen=True)
class Thresholds:
    """Detection parameters. Defaults are the fixed values of the detector."""

    pair_window: str = "1 minute"
    min_ports: int = 8  # alert when distinct ports >= this
    high_ports_factor: float = 1.5  # High when distinct ports > min_ports * factor
    min_bytes: int = 100_000_000  # alert when bytes sent > this
    high_bytes_factor: float = 2.0  # High when bytes > min_bytes * factor
    ioc_window: str = "5 seconds"


DEFAULT = Thresholds()
ALERT_COLUMNS = [f.name for f in ALERT_SCHEMA.fields]


def conform_alerts(df: DataFrame) -> DataFrame:
    """Cast to the declared alert column types (order and element nullability)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA.fields])


def _alert_ts(alert_ts: Column | None) -> Column:
    return F.current_timestamp() if alert_ts is None else alert_ts


def port_count(exact: bool = True) -> Column:
    """Distinct destination ports of a group.

    Exact counting keeps the set of ports (at most 65,536 per group) rather
    than `count(DISTINCT)`: the set partial-aggregates map-side, needs one
    shuffle instead of two, and is also allowed on streams.
    """
    if not exact:
        return F.approx_count_distinct("id_resp_p")
    return F.size(F.collect_set("id_resp_p"))


def pair_activity(
    df: DataFrame,
    kinds: tuple[str, ...] = ("scan", "exfil"),
    exact: bool = True,
    t: Thresholds = DEFAULT,
    alert_ts: Column | None = None,
) -> DataFrame:
    """Port-scan and exfiltration alerts from ONE aggregation.

    Both detectors group by (1-minute window, orig, resp); computing them in
    one `groupBy` reads the input once and keeps one state store in a stream.
    Every aggregate is partial-aggregated before the shuffle, so a hot
    (orig, resp) pair collapses to one row per map task.
    Ports are counted exactly by default (a set of at most 65,536 ports a
    group); `exact=False` is the approximate distinct count.
    """
    # Exfiltration alerts name the earliest record's uid; a scan needs only
    # the earliest time, which keeps the aggregate hash-based.
    aggs = [(F.min(F.struct("ts", "uid")) if "exfil" in kinds else F.struct(
        F.min("ts").alias("ts"), F.lit(None).cast("string").alias("uid"))).alias("first")]
    if "scan" in kinds:
        aggs.append(port_count(exact).alias("port_count"))
    if "exfil" in kinds:
        aggs.append(F.sum("orig_bytes").alias("total_bytes"))
    g = df.groupBy(F.window("ts", t.pair_window).alias("window"), "id_orig_h", "id_resp_h").agg(*aggs)

    candidates = _pair_candidates(kinds, t, _alert_ts(alert_ts))
    return conform_alerts(g.select(F.inline(F.array_compact(F.array(*candidates)))))


def _pair_candidates(kinds: tuple[str, ...], t: Thresholds, ts: Column) -> list[Column]:
    """Alert structs (null where there is no alert) of a group with the columns
    window, id_orig_h, id_resp_h, first, port_count and total_bytes."""

    def alert(alert_type: str, severity: Column, log_uid: Column, tags: Column) -> Column:
        return F.struct(
            alert_id(alert_type, "window", "id_orig_h", "id_resp_h").alias("alert_id"),
            log_uid.alias("log_uid"),
            F.lit(alert_type).alias("alert_type"),
            severity.alias("severity"),
            ts.alias("alert_ts"),
            F.col("first.ts").alias("event_ts"),
            F.col("id_orig_h").alias("orig_ip"),
            F.col("id_resp_h").alias("resp_ip"),
            F.lit(None).cast("int").alias("ioc_score"),
            empty_strings().alias("ioc_source"),
            empty_strings().alias("ioc_value"),
            tags.alias("tags"),
        )

    candidates = []
    if "scan" in kinds:
        n = F.col("port_count")
        candidates.append(F.when(n >= t.min_ports, alert(
            PORT_SCAN,
            F.when(n > t.min_ports * t.high_ports_factor, HIGH).otherwise(MEDIUM),
            F.lit(None).cast("string"),
            F.array(F.lit("port_scan"), F.concat_ws(":", F.lit("ports_count"), n.cast("string"))),
        )))
    if "exfil" in kinds:
        b = F.col("total_bytes")
        candidates.append(F.when(b > t.min_bytes, alert(
            EXFILTRATION,
            F.when(b > t.min_bytes * t.high_bytes_factor, HIGH).otherwise(MEDIUM),
            F.col("first.uid"),
            F.array(F.lit("data_exfiltration"),
                    F.concat_ws(":", F.lit("data_exfiltration_mb"), (b / 1_000_000).cast("string"))),
        )))
    return candidates


def port_scan(df: DataFrame, exact: bool = True, t: Thresholds = DEFAULT, alert_ts: Column | None = None) -> DataFrame:
    """Alert when one (orig, resp) pair touches >= `min_ports` distinct ports in a minute."""
    return pair_activity(df, ("scan",), exact, t, alert_ts)


def data_exfiltration(df: DataFrame, t: Thresholds = DEFAULT, alert_ts: Column | None = None) -> DataFrame:
    """Alert when one (orig, resp) pair sends > `min_bytes` in a minute."""
    return pair_activity(df, ("exfil",), t=t, alert_ts=alert_ts)


CANDIDATE_FIELDS = ("resp_ip", "query", "answer", "host")


def ioc_events(df: DataFrame, dedup: bool | None = None) -> DataFrame:
    """One row per (log row, DNS answer): answers exploded, rows without
    answers kept. Duplicates are dropped on streams (within the watermark)
    by default; batch callers ask for it explicitly."""
    ev = df.select(
        "uid", "ts",
        F.col("id_orig_h").alias("orig_ip"),
        F.col("id_resp_h").alias("resp_ip"),
        "query",
        F.explode_outer("answers").alias("answer"),
        "host",
    )
    if dedup is None:
        dedup = df.isStreaming
    if dedup:
        ev = ev.dropDuplicatesWithinWatermark() if ev.isStreaming else ev.dropDuplicates()
    return ev


def ioc_candidates(df: DataFrame, dedup: bool | None = None) -> DataFrame:
    """Unpivot the four match fields into `match_value` rows (nulls dropped).
    The originator address is deliberately not a candidate."""
    ev = ioc_events(df, dedup)
    return ev.select(
        "uid", "ts", "orig_ip", "resp_ip", "query", "answer", "host",
        F.explode(F.array(*CANDIDATE_FIELDS)).alias("match_value"),
    ).filter(F.col("match_value").isNotNull())


def match_values(df: DataFrame, strict: bool = False) -> DataFrame:
    """(uid, ts, orig_ip, resp_ip, match_value): each distinct value of a log
    row that an indicator may name, once. A row with n answers gives at most
    n + 3 rows."""
    values = F.concat(F.array("id_resp_h", "query", "host"), F.coalesce("answers", empty_strings()))
    if strict:
        values = F.transform(values, normal_value)
    return df.select(
        "uid", "ts", F.col("id_orig_h").alias("orig_ip"), F.col("id_resp_h").alias("resp_ip"),
        F.explode(F.array_distinct(F.array_compact(values))).alias("match_value"),
    )


def salted_join(cand: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """Shuffle equi-join on the match value, with every key spread over
    `buckets` reducers.

    One match value can carry a third of all candidates (a resolver address
    in every DNS answer). Each candidate gets a salt from a hash of its
    (uid, ts) and each indicator key (one row) is replicated once per salt,
    so a hot value is split `buckets` ways; the indicator side grows by
    `buckets` rows per key, never with the log volume.
    """
    salted = cand.withColumn("_salt", F.pmod(F.xxhash64("uid", "ts"), F.lit(buckets)).cast("int"))
    fanned = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = (salted["match_value"] == fanned["ioc_for_match"]) & (salted["_salt"] == fanned["_salt"])
    return salted.join(fanned, cond, "inner").drop(salted["_salt"]).drop(fanned["_salt"])


#: Ways a match value is split when the indicator side is shuffled.
SALT_BUCKETS = 32


def ioc_match(
    df: DataFrame,
    iocs: DataFrame | None,
    t: Thresholds = DEFAULT,
    alert_ts: Column | None = None,
    strict_keys: bool = False,
    broadcast_limit: int | None = None,
    dedup: bool | None = None,
    keys: MatchKeys | None = None,
    salt_buckets: int = SALT_BUCKETS,
    prefilter: bool = False,
) -> DataFrame:
    """Alert per (5-second window, uid) whose log rows hit an indicator.

    The indicators are folded to one row per match key. Log values meet the
    short part of that fold (key, score, flag) in an equi-join that never fans
    a log row out; it is broadcast when its measured size fits, otherwise the
    join is salted `salt_buckets` ways. The aggregate per (window, uid) keeps
    the matched keys only; the lists of indicators, reporters and tags behind
    them join the few alert rows afterwards. Every aggregate is
    duplicate-insensitive, so batch runs skip the dedup shuffle without
    changing the result; streams dedup the (few) hits. `keys` takes prepared
    indicators (a stream reuses one per run). `prefilter` drops most log values
    that no indicator names before they are shuffled, by a broadcast bitmap of
    the keys of bounded size (operators/prefilter.py); it applies where the keys
    themselves are too large to broadcast.
    """
    if keys is None:
        keys = prepared_keys(iocs, strict_keys, broadcast_limit)
    cand = match_values(df, keys.strict)
    side = keys.table.select("ioc_for_match", "score", "compromised")
    if prefilter and not keys.small:
        cand = likely_matches(cand, "match_value", key_bitmap(side, "ioc_for_match"))
    if keys.small:
        hit = cand.join(F.broadcast(side), cand["match_value"] == side["ioc_for_match"])
    elif salt_buckets > 1:
        hit = salted_join(cand, side, salt_buckets)
    else:
        hit = cand.join(side, cand["match_value"] == side["ioc_for_match"])
    if dedup is None:
        dedup = df.isStreaming
    if dedup:
        # Redelivered records are dropped after the join, on hits only: the
        # aggregates below ignore duplicates anyway, and on a stream the
        # dedup keeps dropping rows older than the watermark, as before the
        # join, while its state holds matched rows instead of every row.
        key = ["uid", "ts", "orig_ip", "resp_ip", "match_value"]
        hit = hit.dropDuplicatesWithinWatermark(key) if hit.isStreaming else hit.dropDuplicates(key)
    g = hit.groupBy(F.window("ts", t.ioc_window).alias("window"), "uid").agg(
        F.min(F.struct("ts", "resp_ip", "orig_ip")).alias("first"),
        F.collect_set("match_value").alias("matched"),
        F.max("score").alias("score"),
        F.bool_or("compromised").alias("compromised"),
    )
    # A stream groups a second time by the event time of its windows.
    window = F.window(F.window_time("window"), t.ioc_window) if df.isStreaming else F.col("window")
    lists = keys.table.select("ioc_for_match", "ioc_values", "reporters", "tag_list")
    lists = F.broadcast(lists) if keys.small else lists
    named = g.select("window", "uid", "first", "score", "compromised", F.explode("matched").alias("matched"))
    named = named.join(lists, F.col("matched") == F.col("ioc_for_match"))
    a = named.groupBy(window.alias("window"), "uid").agg(
        F.min("first").alias("first"), F.max("score").alias("score"), F.bool_or("compromised").alias("compromised"),
        *(F.flatten(F.collect_set(c)).alias(c) for c in ("ioc_values", "reporters", "tag_list")),
    )
    return conform_alerts(a.select(*_ioc_columns(F.col("window"), _alert_ts(alert_ts))))


def _ioc_columns(window: Column, ts: Column) -> list[Column]:
    """Alert columns of a group with the columns uid, first, score, compromised,
    ioc_values, reporters and tag_list."""
    return [
        alert_id(IOC_MATCH, window, "uid").alias("alert_id"),
        F.col("uid").alias("log_uid"),
        F.lit(IOC_MATCH).alias("alert_type"),
        F.when(F.col("compromised"), HIGH).otherwise(MEDIUM).alias("severity"),
        ts.alias("alert_ts"),
        F.col("first.ts").alias("event_ts"),
        F.col("first.orig_ip").alias("orig_ip"),
        F.col("first.resp_ip").alias("resp_ip"),
        F.col("score").cast("int").alias("ioc_score"),
        sorted_set("reporters").alias("ioc_source"),
        sorted_set("ioc_values").alias("ioc_value"),
        sorted_set("tag_list").alias("tags"),
    ]


def alerts(
    df: DataFrame,
    iocs: DataFrame | None,
    exact: bool = True,
    t: Thresholds = DEFAULT,
    alert_ts: Column | None = None,
    broadcast_limit: int | None = None,
    keys: MatchKeys | None = None,
    salt_buckets: int = SALT_BUCKETS,
    strict_keys: bool = False,
) -> DataFrame:
    """All three detectors as one alert stream (union by name).

    The two pair detectors share one aggregation, so the input is read twice
    per batch/trigger, not three times.
    """
    ts = _alert_ts(alert_ts)
    return ioc_match(df, iocs, t, ts, strict_keys, broadcast_limit, keys=keys, salt_buckets=salt_buckets).unionByName(
        pair_activity(df, ("scan", "exfil"), exact, t, ts)
    )


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _micros(duration: str) -> int:
    """Microseconds of a window length such as "5 seconds"."""
    n, unit = duration.split()
    return int(n) * _UNITS[unit.rstrip("s")] * 1_000_000


def alerts_one_scan(
    df: DataFrame,
    iocs: DataFrame | None,
    exact: bool = True,
    t: Thresholds = DEFAULT,
    alert_ts: Column | None = None,
    broadcast_limit: int | None = None,
    keys: MatchKeys | None = None,
    salt_buckets: int = SALT_BUCKETS,
    strict_keys: bool = False,
) -> DataFrame:
    """The alerts of `alerts`, from one read of the input and one aggregation.

    A log row fans out into a row for its (orig, resp) pair and one for each
    value that an indicator may name; the values that no indicator names fall
    out at the join. All rows are then grouped by (pair window, kind, key, IOC
    window): a stream keeps one state store in place of three and reads each
    micro-batch once. IOC windows must divide the pair window. The price on a
    stream: an IOC group closes with its pair window, so such an alert may come
    up to a pair window later than from `alerts`. Late hits count while that
    window is open; repeated rows change no IOC alert.
    """
    slot = _micros(t.ioc_window)
    if _micros(t.pair_window) % slot:
        raise ValueError(f"windows of {t.ioc_window} do not divide windows of {t.pair_window}")
    keys = keys or prepared_keys(iocs, strict_keys, broadcast_limit)
    values = F.concat(F.array("id_resp_h", "query", "host"), F.coalesce("answers", empty_strings()))
    if keys.strict:
        values = F.transform(values, normal_value)
    pair = F.struct(F.lit(True).alias("pair"), F.lit(None).cast("string").alias("value"))
    named = F.transform(F.array_distinct(F.array_compact(values)), lambda v: F.struct(F.lit(False).alias("pair"), v.alias("value")))
    fan = df.select("uid", "ts", "id_orig_h", "id_resp_h", "id_resp_p", "orig_bytes", F.inline(F.concat(F.array(pair), named)))
    side = keys.table.select("ioc_for_match", "score", "compromised", F.struct("ioc_values", "reporters", "tag_list").alias("lists"))
    if keys.small:
        rows = fan.join(F.broadcast(side), F.col("value") == F.col("ioc_for_match"), "left")
    else:
        # Pair rows, which match nothing, get values of their own, so that they
        # spread; a match value is split `salt_buckets` ways.
        spread = F.coalesce("value", F.concat(F.lit("\0"), F.xxhash64("uid", "ts", "id_resp_p").cast("string")))
        salted = fan.withColumns({"_value": spread, "_salt": F.pmod(F.xxhash64("uid", "ts"), F.lit(salt_buckets)).cast("int")})
        fanned = side.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        rows = salted.join(fanned, (F.col("_value") == F.col("ioc_for_match")) & (F.col("_salt") == F.col("_of")), "left")
    rows = rows.where(F.col("pair") | F.col("ioc_for_match").isNotNull())
    mine, hit = F.col("pair"), ~F.col("pair")
    micros = F.unix_micros("ts")
    g = rows.groupBy(
        F.window("ts", t.pair_window).alias("window"), "pair",
        F.when(mine, F.col("id_orig_h")).alias("id_orig_h"), F.when(mine, F.col("id_resp_h")).alias("id_resp_h"),
        F.when(hit, F.col("uid")).alias("uid"), F.when(hit, micros - F.pmod(micros, F.lit(slot))).alias("slot"),
    ).agg(
        F.min(F.when(mine, F.struct("ts", "uid"))).alias("pair_first"),
        (F.size(F.collect_set(F.when(mine, F.col("id_resp_p")))) if exact else F.approx_count_distinct(F.when(mine, F.col("id_resp_p")))).alias("port_count"),
        F.sum(F.when(mine, F.col("orig_bytes"))).alias("total_bytes"),
        F.min(F.when(hit, F.struct("ts", F.col("id_resp_h").alias("resp_ip"), F.col("id_orig_h").alias("orig_ip")))).alias("hit_first"),
        F.collect_set(F.when(hit, F.col("lists"))).alias("lists"),
        F.max("score").alias("score"),
        F.bool_or("compromised").alias("compromised"),
    )
    at = _alert_ts(alert_ts)
    of_pairs = g.select("*", F.col("pair_first").alias("first"))
    pairs = [F.when(mine, c).alias(f"_{i}") for i, c in enumerate(_pair_candidates(("scan", "exfil"), t, at))]
    flat = of_pairs.select("*", *pairs).withColumns({
        "first": F.col("hit_first"),
        **{c: F.flatten(F.col(f"lists.{c}")) for c in ("ioc_values", "reporters", "tag_list")},
    })
    window = F.struct(F.timestamp_micros("slot").alias("start"))
    found = F.when(hit, F.struct(*_ioc_columns(window, at)))
    return conform_alerts(flat.select(F.inline(F.array_compact(F.array(*(F.col(f"_{i}") for i in range(len(pairs))), found)))))

"""Indicator (IOC) table operators: cleaning raw feed rows, the match-key
table used by the detector, and the incremental merge into one row per id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import match_key, parse_feed_time
from tidewatch.functions.sizing import broadcast_if_small, fits
from tidewatch.functions.sizing import broadcast_limit as limit_of
from tidewatch.schemas import CLEAN_IOC_SCHEMA, RAW_IOC_ENTRY
from tidewatch.session import checkpoint_root

CLEAN_COLUMNS = [f.name for f in CLEAN_IOC_SCHEMA.fields]
_DECLARED = [f.name for f in RAW_IOC_ENTRY.fields]
# Fixed value: feed times are shifted by this many hours (feed-local offset).
FEED_SHIFT_HOURS = 3
# Fixed value: reporter name the feed uses for "no reporter".
ANONYMOUS = "anonymous"


# ----------------------------------------------------------------- matching

def with_match_key(iocs: DataFrame, strict: bool = False) -> DataFrame:
    """Adds `ioc_for_match`, the value log fields are compared with."""
    return iocs.withColumn("ioc_for_match", match_key("ioc", "ioc_type", strict))


def fold_indicators(iocs: DataFrame, strict: bool = False) -> DataFrame:
    """One row per match key with everything an alert needs from indicators.

    Many indicators can share a key (all URLs of one host); folding them here
    keeps the detector's join one-to-one.
    """
    return (
        with_match_key(iocs, strict)
        .filter(F.col("ioc_for_match") != "")  # no key, or a URL without a host
        .groupBy("ioc_for_match")
        .agg(
            F.collect_set("ioc").alias("ioc_values"),
            F.collect_set("reporter").alias("reporters"),
            F.max("confidence_level").alias("score"),
            F.array_distinct(F.flatten(F.collect_set(F.coalesce("tags", F.array().cast("array<string>"))))).alias("tag_list"),
            F.bool_or(F.coalesce(F.col("is_compromised"), F.lit(False))).alias("compromised"),
        )
    )


@dataclass(frozen=True)
class MatchKeys:
    """Indicators folded per match key; `small`: their measured size fits a
    broadcast; `strict`: keys and log values follow the strict rule."""

    table: DataFrame
    small: bool
    strict: bool = False


def prepared_keys(iocs: DataFrame, strict: bool = False, limit: int | None = None) -> MatchKeys:
    """Fold the indicators and measure the fold, which the join then reuses:
    it is written once to the shared checkpoint folder."""
    checkpoint_root(iocs.sparkSession)
    folded = fold_indicators(iocs, strict).checkpoint(eager=True)
    return MatchKeys(folded, fits(folded, limit), strict)


# ----------------------------------------------------------------- cleaning

def explode_raw(raw: DataFrame) -> DataFrame:
    """Raw feed documents -> one row per indicator (empty/null `data` gives
    no rows). Payload fields outside `RAW_IOC_ENTRY` ride along as one JSON
    object in `extra` (null if there are none). Partition columns and
    `folder_date` ride along if present."""
    keep = [c for c in ("year", "month", "day", "folder_date") if c in raw.columns]
    one = raw.select(F.explode("data").alias("_e"), *keep)
    if isinstance(one.schema["_e"].dataType, T.StructType):
        names = one.schema["_e"].dataType.names
        more = [F.col(f"_e.`{n}`") for n in names if n not in _DECLARED]
        extra = F.to_json(F.struct(*more)) if more else F.lit("{}")
        entry = [F.col(f"_e.`{n}`") for n in names if n in _DECLARED]
    else:
        one = one.select("*", F.from_json("_e", RAW_IOC_ENTRY).alias("_p"))
        # Numbers, lists and objects stay as their JSON text in the map.
        pairs = F.map_filter(F.from_json("_e", "map<string,string>"), lambda k, v: ~k.isin(*_DECLARED) & v.isNotNull())
        extra = F.coalesce(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(pairs)))), F.lit("{}"))
        entry = [F.col("_p.*")]
    return one.select(*entry, F.nullif(extra, F.lit("{}")).alias("extra"), *keep)


def explode_raw_typed(raw: DataFrame) -> DataFrame:
    """`explode_raw` from one parse of each indicator (its JSON text in `data`),
    into a map of VARIANT values: declared fields are taken out of it with their
    types, and `extra` is the JSON object of all other fields, in which numbers,
    lists and objects keep their types. A field of another type than declared is
    cast where that is possible, else null; text that is no JSON object gives a
    row of nulls."""
    keep = [c for c in ("year", "month", "day", "folder_date") if c in raw.columns]
    one = raw.select(F.explode("data").alias("_e"), *keep)
    one = one.select(F.from_json("_e", "map<string,variant>").alias("_m"), *keep)
    entry = [F.try_variant_get(F.try_element_at("_m", F.lit(f.name)), "$", f.dataType.simpleString()).alias(f.name) for f in RAW_IOC_ENTRY.fields]
    more = F.map_filter("_m", lambda k, v: ~k.isin(*_DECLARED) & ~F.is_variant_null(v))
    ordered = F.map_from_entries(F.transform(F.array_sort(F.map_keys(more)), lambda k: F.struct(k.alias("key"), F.element_at(more, k).alias("value"))))
    extra = F.nullif(F.to_json(ordered), F.lit("{}"))
    return one.select(*entry, extra.alias("extra"), *keep)


def clean_iocs(entries: DataFrame, shift_hours: int = FEED_SHIFT_HOURS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalise flat raw indicators into `CLEAN_IOC_SCHEMA`.

    - reporter `anonymous` -> null; empty `reference` -> null
    - missing `last_seen` -> `first_seen`; times parsed as UTC, bad text ->
      null, then shifted by `shift_hours`
    - `id` := sha256(ioc), replacing any feed id; rows without `ioc` dropped
    - `confidence_level` -> int (junk -> null)
    - payload fields outside the schema stay as JSON in `extra`
    """
    present = set(entries.columns)

    def c(name: str) -> Column:
        if name in present:
            return F.col(name)
        dtype = next(f.dataType for f in RAW_IOC_ENTRY.fields if f.name == name)
        return F.lit(None).cast(dtype)

    out = {
        "id": F.sha2(c("ioc"), 256),
        "ioc": c("ioc"),
        "threat_type": c("threat_type"),
        "ioc_type": c("ioc_type"),
        "malware": c("malware"),
        "malware_printable": c("malware_printable"),
        # numeric text -> int, truncating like a numeric cast; junk or an
        # out-of-range value -> null
        "confidence_level": c("confidence_level").cast("string").try_cast("double").try_cast("int"),
        "first_seen": parse_feed_time(c("first_seen"), shift_hours),
        "last_seen": parse_feed_time(F.coalesce(c("last_seen"), c("first_seen")), shift_hours),
        "reference": F.nullif(c("reference"), F.lit("")),
        "reporter": F.nullif(c("reporter"), F.lit(ANONYMOUS)),
        "tags": c("tags"),
        "is_compromised": c("is_compromised"),
        "extra": F.col("extra") if "extra" in present else F.lit(None).cast("string"),
    }
    cols = [out[n].cast(CLEAN_IOC_SCHEMA[n].dataType).alias(n) for n in CLEAN_COLUMNS]
    return entries.filter(c("ioc").isNotNull()).select(*cols, *keep)


# ------------------------------------------------------------------ merging

def _pick_order(src: Column | None = None) -> Column:
    """Total order used to pick one representative row per id: current table
    first, then earliest `first_seen`, then every other column."""
    rest = [n for n in CLEAN_COLUMNS if n not in ("id", "first_seen")]
    head = [src.alias("_src")] if src is not None else []
    return F.struct(*head, F.col("first_seen"), *[F.col(n) for n in rest])


def batch_per_id(batch: DataFrame) -> DataFrame:
    """One row per id from a cleaned batch: the earliest row's attributes and
    the latest `last_seen` seen for the id anywhere in the batch."""
    return _fold(batch.select(*CLEAN_COLUMNS).withColumn("_src", F.lit(1)))


def _fold(tagged: DataFrame) -> DataFrame:
    g = tagged.groupBy("id").agg(
        F.min(_pick_order(F.col("_src"))).alias("_p"),
        F.max("last_seen").alias("_last"),
    )
    cols = [F.col("id")] + [
        (F.col("_last") if n == "last_seen" else F.col(f"_p.{n}")).alias(n) for n in CLEAN_COLUMNS if n != "id"
    ]
    return g.select(*cols)


def new_iocs(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the batch that the table does not have yet (one row each)."""
    return batch_per_id(batch).join(current.select("id"), "id", "left_anti")


def refresh_last_seen(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Current rows with `last_seen` raised to the latest value in the batch."""
    latest = batch.groupBy("id").agg(F.max("last_seen").alias("_inc"))
    return (
        current.select(*CLEAN_COLUMNS)
        .join(latest, "id", "left")
        .withColumn("last_seen", F.greatest("last_seen", "_inc"))
        .select(*CLEAN_COLUMNS)
    )


def merge_iocs(current: DataFrame | None, batch: DataFrame, broadcast_limit: int | None = None, unique: bool = False) -> DataFrame:
    """New table = current table merged with a cleaned batch, one row per id:
    the current row if the id is known (with `last_seen` raised to the
    batch's latest), else the earliest batch row with the batch's latest
    `last_seen`. Equals new_iocs(...) UNION refresh_last_seen(...) on a table
    without repeated ids. Idempotent: merging the same batch again changes
    nothing.

    `unique=True` states that `current` holds each id once, as every snapshot
    of the refresh job does. The increment, folded per id, is then broadcast
    when it measures small and the table is never shuffled. Otherwise table
    and increment are folded together with one shuffle on `id`. Both give the
    same rows.
    """
    if current is None:
        return batch_per_id(batch)
    # The folded increment feeds the size check and the joins: materialise
    # it once in the shared checkpoint folder (reliable, lineage cut).
    checkpoint_root(batch.sparkSession)
    folded = batch_per_id(batch).checkpoint(eager=True)
    latest, size = broadcast_if_small(folded.select("id", F.col("last_seen").alias("_inc")), broadcast_limit)
    if not unique or not (size.exact and size.bytes <= limit_of(folded, broadcast_limit)):
        # Picking per id over (table, folded increment) equals picking over
        # (table, raw increment): the fold already holds each id's pick.
        tagged = current.select(*CLEAN_COLUMNS).withColumn("_src", F.lit(0)).unionByName(
            folded.select(*CLEAN_COLUMNS).withColumn("_src", F.lit(1)))
        return _fold(tagged)
    table = current.select(*CLEAN_COLUMNS)
    refreshed = (
        table.join(latest, "id", "left")
        .withColumn("last_seen", F.greatest("last_seen", "_inc"))
        .select(*CLEAN_COLUMNS)
    )
    known = table.select("id").join(latest.select("id"), "id", "left_semi")  # reads the id column only; at most |increment| rows
    return refreshed.unionByName(folded.join(known, "id", "left_anti"))

"""Longest-prefix lookup of addresses in a table of network segments.

An address is its bits as text after a mark of its family ("4" and 32 bits, "6"
and 128 bits), a segment the same text cut to its prefix length. An address lies
in a segment exactly if its text begins with the segment's, so for each prefix
length that the table has, the lookup is an equality on the cut text; the
longest one that hits wins.

Defined results: text that is no address, and null, lie in no segment; CIDR text
that is none is left out of the table (`invalid_segments` counts it); bits of a
CIDR beyond its length do not count; a CIDR without a length is one address; of
several names for one segment the smallest counts. IPv6 may be shortened, in
upper case, end in a dotted quad or in a zone; IPv4 written inside IPv6 stays
IPv6.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import col, ipv4_to_long
from tidewatch.functions.sizing import fits
from tidewatch.session import checkpoint_root

#: Prefixes this short are few (at most 2**17 of a family), so they are always broadcast.
SHORT_BITS = 16
SALTS = 32
DOTTED_TAIL = r"^(.*:)(\d+\.\d+\.\d+\.\d+)$"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def _groups(half: Column) -> Column:
    return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))


def _v6_bits(text: Column) -> Column:
    """The 128 bits of an IPv6 address; null for other text."""
    plain = lambda t: _let(ipv4_to_long(F.regexp_extract(t, DOTTED_TAIL, 2)), lambda quad: F.when(quad.isNotNull(), F.concat(
        F.regexp_extract(t, DOTTED_TAIL, 1), F.lower(F.hex(F.shiftright(quad, 16))), F.lit(":"), F.lower(F.hex(quad.bitwiseAND(F.lit(65535)))))).otherwise(t))
    halves = lambda t: F.split(t, "::", -1)
    sides = lambda h: F.struct(
        F.size(h).alias("parts"), _groups(h.getItem(0)).alias("left"), _groups(F.coalesce(F.try_element_at(h, F.lit(2)), F.lit(""))).alias("right"))
    filled = lambda s: F.when(
        ((s["parts"] == 1) & (F.size(s["left"]) == 8)) | ((s["parts"] == 2) & (F.size(s["left"]) + F.size(s["right"]) <= 7)),
        F.concat(s["left"], F.array_repeat(F.lit("0"), 8 - F.size(s["left"]) - F.size(s["right"])), s["right"]))
    bits = lambda g: F.when(F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$")),
                            F.array_join(F.transform(g, lambda x: F.lpad(F.conv(x, 16, 2), 16, "0")), ""))
    steps = (plain, halves, sides, filled, bits)
    out = F.substring_index(text, "%", 1)
    for step in steps:
        out = _let(out, step)
    return out


def address_bits(ip: str | Column) -> Column:
    """Family mark and bits of an address; null for any other text."""
    return _let(F.lower(F.trim(col(ip))), lambda t: F.when(t.contains(":"), F.concat(F.lit("6"), _v6_bits(t))).otherwise(
        F.concat(F.lit("4"), F.lpad(F.bin(ipv4_to_long(t)), 32, "0"))))


def _cidr_key(cidr: str) -> Column:
    """A segment's family mark and prefix bits; null for text that is no CIDR."""
    given = F.when(F.col(cidr).contains("/"), F.substring_index(cidr, "/", -1).try_cast("int"))
    cut = lambda b: _let(F.coalesce(given, F.when(~F.col(cidr).contains("/"), F.length(b) - 1)), lambda n: F.when(
        (n >= 0) & (n <= F.length(b) - 1), F.substring(b, F.lit(1), n + 1)))
    return _let(address_bits(F.substring_index(cidr, "/", 1)), cut)


def prefix_table(segments: DataFrame, name: str = "name", cidr: str = "cidr") -> DataFrame:
    """(prefix, segment): each segment once."""
    keyed = segments.select(_cidr_key(cidr).alias("prefix"), F.col(name).alias("segment")).where(F.col("prefix").isNotNull())
    return keyed.groupBy("prefix").agg(F.min("segment").alias("segment"))


def invalid_segments(segments: DataFrame, cidr: str = "cidr") -> int:
    """Rows whose CIDR is null or none."""
    return segments.where(_cidr_key(cidr).isNull()).count()


def _probe(df: DataFrame, table: DataFrame, bits: str, lengths: list[int]) -> tuple[DataFrame, list[Column]]:
    """One broadcast lookup for each prefix length, longest first."""
    found = []
    for n in sorted(lengths, reverse=True):
        side = table.where(F.length("prefix") == n).select(F.col("prefix").alias(f"_p{n}"), F.col("segment").alias(f"_s{n}"))
        df = df.join(F.broadcast(side), F.substring(bits, 1, n) == F.col(f"_p{n}"), "left").drop(f"_p{n}")
        found.append(F.col(f"_s{n}"))
    return df, found


def with_segment(df: DataFrame, ip: str, segments: DataFrame, out: str = "segment", limit: int | None = None,
                 name: str = "name", cidr: str = "cidr") -> DataFrame:
    """Adds the name of the longest segment that holds the address `ip`.

    A table that measures small is broadcast, a part for each prefix length, and
    `df` is not shuffled. A larger one is joined with the distinct addresses,
    each cut to the lengths that the table has, spread over salts; the answer
    comes back by an outer join, whose hot addresses the engine splits. Short
    prefixes, which any number of addresses share, are few and stay broadcast.
    """
    checkpoint_root(df.sparkSession)
    table = prefix_table(segments, name, cidr).checkpoint(eager=True)
    lengths = [r[0] for r in table.select(F.length("prefix")).distinct().collect()]  # at most 33 + 129
    # A generator computes the bits once; as a projection they would be computed
    # again in each lookup.
    bits = df.select("*", F.explode(F.array(address_bits(ip))).alias("_bits"))
    if fits(table, limit):
        probed, found = _probe(bits, table, "_bits", lengths)
        answer = F.coalesce(*found) if found else F.lit(None).cast("string")
        return probed.select(*(F.col(f"`{c}`") for c in df.columns), answer.alias(out))
    addresses = bits.select("_bits").where(F.col("_bits").isNotNull()).distinct()
    long = [n for n in lengths if n > SHORT_BITS + 1]
    cut = addresses.select("_bits", F.explode(F.array(*(F.lit(n) for n in long))).alias("_n")).where(F.col("_n") <= F.length("_bits"))
    cut = cut.select("_bits", F.substring("_bits", F.lit(1), F.col("_n")).alias("_cut"), F.pmod(F.xxhash64("_bits"), F.lit(SALTS)).cast("int").alias("_salt"))
    fanned = table.where(F.length("prefix") > SHORT_BITS + 1).withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hit = cut.join(fanned, (F.col("_cut") == F.col("prefix")) & (F.col("_salt") == F.col("_of")))
    best = hit.groupBy("_bits").agg(F.max_by("segment", F.length("prefix")).alias("_long"))
    probed, found = _probe(bits, table, "_bits", [n for n in lengths if n <= SHORT_BITS + 1])
    return probed.join(best, "_bits", "left").select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce("_long", *found).alias(out))

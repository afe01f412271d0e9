"""Distinct destination ports as mergeable sketches.

`port_sketches` keeps one HyperLogLog sketch a (window, source, destination).
Sketches of any windows and destinations merge without the log: a longer window,
or one source over all its destinations, is a union of stored sketches, where a
plain approximate count would need every log row again.

Defined results: rows without a time are left out, null ports do not count, a
group without ports has an estimate of 0. Counts up to a few thousand ports are
within four standard deviations, `error_bound`, of the exact ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's buckets: 2**12 buckets, about 2-4 KB and a relative
#: standard deviation of 1.04 / sqrt(2**12).
LG_BUCKETS = 12
DEVIATION = 1.04 / 2 ** (LG_BUCKETS / 2)


def error_bound(exact: Column) -> Column:
    """Four standard deviations of a count, and one for rounding."""
    return exact * (4 * DEVIATION) + 1


def port_sketches(df: DataFrame, window: str = "1 minute", keys: tuple[str, ...] = ("id_orig_h", "id_resp_h")) -> DataFrame:
    """(window, keys, ports): a sketch of the distinct ports of each group."""
    return df.groupBy(F.window("ts", window).alias("window"), *keys).agg(F.hll_sketch_agg("id_resp_p", LG_BUCKETS).alias("ports"))


def merged(sketches: DataFrame, window: str, keys: tuple[str, ...] = ("id_orig_h",)) -> DataFrame:
    """Sketches united to longer windows (multiples of the stored ones) and
    fewer keys."""
    return sketches.groupBy(F.window(F.col("window.start"), window).alias("window"), *keys).agg(F.hll_union_agg("ports").alias("ports"))


def with_estimate(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("port_count", F.hll_sketch_estimate("ports"))


def wide_scans(sketches: DataFrame, window: str = "10 minutes", min_ports: int = 50) -> DataFrame:
    """Sources that reach `min_ports` distinct ports or more over all their
    destinations in a window: a scan spread over hosts, which no pair shows."""
    return with_estimate(merged(sketches, window)).where(F.col("port_count") >= min_ports)

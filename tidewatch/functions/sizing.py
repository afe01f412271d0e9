"""Measured size checks for broadcast decisions.

A broadcast side is shipped to every executor and held in memory there, so it
is only broadcast after its actual size has been measured with one
aggregation job. Beyond the limit the caller keeps a shuffle join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row and per-field overhead of Spark's binary row format, in bytes.
_ROW_OVERHEAD = 16
_FIELD_BYTES = 8
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def _value_bytes(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(dtype, T.ArrayType):
        elem = dtype.elementType
        inner = F.aggregate(
            c, F.lit(0).cast("long"),
            lambda acc, x: acc + _value_bytes(x, elem) + F.lit(_FIELD_BYTES),
        )
        return F.coalesce(inner, F.lit(0).cast("long"))
    if isinstance(dtype, T.StructType):
        total = F.lit(0).cast("long")
        for f in dtype.fields:
            total = total + _value_bytes(c.getField(f.name), f.dataType) + F.lit(_FIELD_BYTES)
        return total
    if isinstance(dtype, T.MapType):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(0).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of one row's in-memory size."""
    total = F.lit(_ROW_OVERHEAD + _FIELD_BYTES * len(df.schema.fields)).cast("long")
    for f in df.schema.fields:
        total = total + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total


@dataclass(frozen=True)
class Measured:
    rows: int
    bytes: int
    exact: bool = True  # False: `bytes` is only a lower bound


def measure(df: DataFrame, limit: int | None = None) -> Measured:
    """Row count and byte size of `df`, each a partial+final aggregate.

    With a `limit`, the row count comes first (for a file-backed side it
    reads no column data); if rows times the fixed per-row size already
    exceeds the limit, the byte scan is skipped and a lower bound returned.
    """
    if limit is not None:
        n = df.count()
        floor = n * (_ROW_OVERHEAD + _FIELD_BYTES * len(df.schema.fields))
        if floor > limit:
            return Measured(n, floor, exact=False)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return Measured(int(r["n"]), int(r["b"] or 0))


def broadcast_limit(df: DataFrame, limit: int | None = None) -> int:
    if limit is not None:
        return limit
    conf = df.sparkSession.conf.get("spark.tidewatch.broadcastLimitBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_LIMIT


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, Measured]:
    """`broadcast(df)` when its measured size fits `limit`, else `df` unchanged
    (Spark then plans a shuffle join, which AQE may still convert at runtime)."""
    cap = broadcast_limit(df, limit)
    m = measure(df, cap)
    return (F.broadcast(df) if m.exact and m.bytes <= cap else df), m


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the measured size of `df` is within the broadcast limit."""
    cap = broadcast_limit(df, limit)
    m = measure(df, cap)
    return m.exact and m.bytes <= cap

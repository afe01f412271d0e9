"""Shared helpers of the text operators.

Texts are handled inside Arrow tasks as one flat byte buffer per block of
documents: word bounds, word hashes and k-gram hashes are numpy passes over
that buffer, never Python loops over words. A block holds about
``BLOCK_BYTES`` of text (a single longer document is a block of its own).

Null text counts as empty text throughout.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import checkpoint_root

BLOCK_BYTES = 4 << 20
_B = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_B_INV = pow(_B, -1, 1 << 64)
_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as
    in local mode or a shared installation; elsewhere ship it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared folder (`spark.checkpoint.dir`)."""
    return f"{checkpoint_root(spark).rstrip('/')}/tidewatch-llm/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage ends here,
    and a lost executor costs a reread of files, not a recomputation."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; row i is bytes[offsets[i]:offsets[i + 1]]."""
    if pa.types.is_large_string(texts.type) or pa.types.is_string_view(texts.type):
        texts = texts.cast(pa.large_string())
        kind = np.int64
    else:
        kind = np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, offs, data = texts.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows holding at most `limit` bytes of text (or one row)."""
    buf, offs = flat(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte unchanged."""
    return _LOWER[buf]


def words(buf: np.ndarray, offs: np.ndarray, word_byte: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of all words of a block: (start, end, first word of each row plus
    the total). Words are runs of bytes other than 0x20 and 0x09-0x0D, or of
    those `word_byte` (256 flags) marks; no word crosses a row's edge."""
    on = ~_WS[buf] if word_byte is None else word_byte[buf]
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    opens = on.copy()
    opens[1:] &= ~on[:-1] | edge[1:-1]
    closes = on.copy()
    closes[:-1] &= ~on[1:] | edge[1:-1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offs)


def _power(n: int, base: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            p = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            p[0] = 1
            have = np.cumprod(p)
        if n <= 4 * BLOCK_BYTES:  # the powers for one very long text are not kept
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (polynomial from prefix sums)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power(len(buf), _B)[:len(buf)], out=sums[1:])
        h = (sums[end] - sums[start]) * _power(len(buf), _B_INV)[start]
    return mix(h)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i..i+k-1 for each i (len(h) - k + 1 values; rows not regarded)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out *= np.uint64(_B_INV)
            out += h[j:j + n]
    return mix(out)


def gram_rows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For `first` from words(): (index, row) of every k-gram lying in one row."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    skipped = np.concatenate(([0], np.cumsum(n)))[:-1]
    return np.arange(n.sum()) - skipped[row] + first[:-1][row], row


def crc_remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo `divisor`."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def id_column(df: DataFrame, name: str = "doc_id"):
    from pyspark.sql import functions as F

    return F.col(f"`{name}`").cast("long").alias(name)

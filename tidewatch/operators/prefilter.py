"""A bitmap of join keys, to drop rows that cannot match before a shuffle.

Spark's own runtime filter follows a join key down to a scan; the values that
the detector matches are exploded from several columns, so it does not apply
there. This one is plain DataFrame code: each key sets one bit of a bitmap of
`words` 64-bit words, folded with `bit_or`; the other side looks its word up in
a broadcast join and keeps the rows whose bit is set. The broadcast has at most
`words` rows whatever the number of keys. All matching rows pass, and of the
others about keys / (64 * words).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20  # 64 Mbit; at most about 40 MB as a broadcast table


def _places(column: str, words: int) -> tuple:
    """Word and bit of a key, from different bits of its hash."""
    h = f"xxhash64(`{column}`)"
    return F.expr(f"pmod({h}, {words}L)"), F.expr(f"shiftleft(1L, cast(pmod(shiftright({h}, 48), 64) as int))")


def key_bitmap(keys: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """(word, bits) of all keys; null keys set no bit."""
    word, bit = _places(column, words)
    return keys.where(F.col(column).isNotNull()).select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def likely_matches(df: DataFrame, column: str, bitmap: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows whose `column` may be one of the bitmap's keys."""
    word, bit = _places(column, words)
    probed = df.withColumn("_at", word).join(F.broadcast(bitmap), F.col("_at") == F.col("_word"))
    return probed.where(F.col("_bits").bitwiseAND(bit) != 0).drop("_at", "_word", "_bits")

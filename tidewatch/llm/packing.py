"""Packing documents into sequences of a fixed length by minimum bin slack.

A document is its token ids and a closing id 0. It is cut at every `capacity`
ids; whole pieces are sequences of their own and the remainder is a piece of
1 to capacity - 1 ids. What is left to pack is then a multiset of lengths, of
which there are at most capacity - 1 different ones whatever the corpus.

Each window takes the multiset that fills it closest to capacity: it starts
from the longest piece left, and a bitset subset-sum over the lengths left
(bit s of the set after i lengths: sum s can be reached) gives the best sum,
whose counts are read back from the sets. Long lengths enter the sets first, so
short ones are spent only where they are needed. The same window
is repeated while the counts last, so the number of different windows follows
from the capacity, not from the corpus. A window that cannot be filled although
pieces are left takes the head of one of them, cut to the gap; its rest goes
back among the lengths. So at most one sequence of the whole result is short.

Defined results: null and empty texts have the id 0 alone and are packed like
others; rows without a doc_id, repeated ids and repeated rows are documents of
their own; an empty table gives no rows; other columns are ignored. Special
tokens' strings become their ids, as the vocabulary file says.

Scale: one pass tokenises, numbers the pieces of each length inside
its task and writes them; the counts by (task, length) give each task its place
in the order of a length, so a length that a third of all documents have is
spread over all tasks. The plan is made on the driver from at most `capacity`
counts; tasks get it as a closure. Piece ids, in two bytes each where the
vocabulary allows, are written for remainders only, since only those may be cut.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, id_column, stored
from tidewatch.llm.tokens import byte_level

CAPACITY = 1024
END = 0
_NONE = np.zeros(0, np.uint32)
_PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, place long, ids binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, with the longest one in it, whose sum is closest
    to `capacity` from below."""
    order = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    if not order:
        return {}
    seed = order[0]
    room = capacity - seed
    left = [(n, min(counts[n] - (n == seed), room // n)) for n in order]  # long lengths enter first, short ones are kept
    left = [(n, c) for n, c in left if c > 0]
    mask = (1 << (room + 1)) - 1
    reach, before = 1, []
    for n, c in left:
        before.append(reach)
        step = 1
        while c > 0:  # 1, 2, 4, .. pieces at a time
            step = min(step, c)
            reach |= reach << (n * step) & mask
            c -= step
            step *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = defaultdict(int)
    chosen[seed] = 1
    for (n, c), sums in zip(reversed(left[:len(before)]), reversed(before)):
        while not sums >> at & 1:
            at -= n
            chosen[n] += 1
    return dict(chosen)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[np.ndarray], int]:
    """Windows for `counts` pieces of each length: ([rows by number of cuts
    before], number of windows). A row (length, a, b, head, size, window, skip,
    each, at) says where the pieces a..b-1 of a length go with their ids
    head..head+size-1: piece a + i to window + (skip + i) // each, at offset
    at + (skip + i) % each * size."""
    have = {n: int(c) for n, c in counts.items() if c}
    pool = {n: deque([(n, 0, c, 0, 0)]) for n, c in have.items()}  # (length, a, b, head, cuts)
    rows: list[list[tuple]] = []

    def take(n: int, count: int) -> list[tuple]:
        have[n] -= count
        out, queue = [], pool[n]
        while count:
            length, a, b, head, cuts = queue.popleft()
            if b - a > count:
                queue.appendleft((length, a + count, b, head, cuts))
                b = a + count
            out.append((length, a, b, head, cuts))
            count -= b - a
        return out

    def place(runs: list[tuple], size: int, window: int, each: int, at: int) -> None:
        skip = 0
        for length, a, b, head, cuts in runs:
            while len(rows) <= cuts:
                rows.append([])
            rows[cuts].append((length, a, b, head, size, window, skip, each, at))
            skip += b - a

    windows = 0
    while any(have.values()):
        chosen = closest_fill(have, capacity)
        gap = capacity - sum(n * c for n, c in chosen.items())
        need = dict(chosen)
        # The shortest piece that is longer than the gap loses its head to it.
        cut = min((n for n, c in have.items() if n > gap and c > chosen.get(n, 0)), default=None) if gap else None
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(have[n] // c for n, c in need.items())
        at = 0
        for n in sorted(chosen, reverse=True):
            place(take(n, times * chosen[n]), n, windows, chosen[n], at)
            at += n * chosen[n]
        if cut:
            runs = take(cut, times)
            place(runs, gap, windows, 1, at)
            rest = cut - gap
            have[rest] = have.get(rest, 0) + times
            pool.setdefault(rest, deque()).extend((length, a, b, head + gap, cuts + 1) for length, a, b, head, cuts in runs)
        windows += times
    return [np.array(sorted(r), np.int64) for r in rows], windows


def token_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, written to the shared folder: `part` and
    `place` number the pieces of a length. `keep_ids`: whole pieces hold their
    ids too, not remainders only."""

    def task(batches):
        encode = byte_level(path)
        part = TaskContext.get().partitionId()
        placed = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, _, _ in blocks(batch):
                ids = [encode(t) if t else _NONE for t in rows.column("text").to_pylist()]
                size = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
                n_docs = len(ids)
                begin = np.cumsum(size) - size
                tokens = np.full(int(size.sum()), END, np.uint32)
                body = np.ones(len(tokens), bool)
                body[begin + size - 1] = False
                tokens[body] = np.concatenate(ids)
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(n_docs), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(size[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                same = length[order]
                place = np.empty(len(doc), np.int64)
                place[order] = placed[same] + np.arange(len(same)) - np.searchsorted(same, same)
                placed += np.bincount(length, minlength=capacity + 1)
                at = begin[doc] + start
                raw = tokens.tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist())]
                kept = [raw[4 * a:4 * (a + m)] if keep_ids or m < capacity else None for a, m in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()),
                    pa.array(size[doc], pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(place), pa.array([_narrow(k) for k in kept], pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place", "ids"])

    return stored(documents.select(id_column(documents), F.col("text")).mapInArrow(task, _PIECE), "pieces")


def _narrow(ids: bytes | None) -> bytes | None:
    """Ids in two bytes each where they fit, after a byte that names the width."""
    if ids is None:
        return None
    wide = np.frombuffer(ids, np.uint32)
    return b"\x02" + wide.astype(np.uint16).tobytes() if not len(wide) or wide.max() < 1 << 16 else b"\x04" + ids


def _wide(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.uint16 if ids[0] == 2 else np.uint32, offset=1).astype(np.uint32)


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there, and, with
    `keep_ids`, its ids (`unpacked_ids` reads them)."""
    pieces = token_pieces(documents, path, capacity, keep_ids)
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = stored(by_task.withColumn("before", F.coalesce(before, F.lit(0))), "piece-places")
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in places.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, windows = plan({n: c for n, c in counts.items() if n < capacity}, capacity)
    whole = np.array([(capacity, 0, counts.get(capacity, 0), 0, capacity, windows, 0, 1, 0)], np.int64)
    levels = [np.concatenate((rows[0], whole)) if rows else whole, *rows[1:]]

    def task(batches):
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("before").to_numpy() + batch.column("place").to_numpy()
            for level, table in enumerate(levels):
                # Rows of one level do not overlap and are sorted by (length, a).
                at = _last_not_above(table[:, 0], table[:, 1], length, number)
                hit = np.flatnonzero((at >= 0) & (table[at, 0] == length) & (number < table[at, 2]))
                if not len(hit):
                    continue
                r, t = table[at[hit]], number[hit]
                i = r[:, 6] + t - r[:, 1]
                part = batch.take(pa.array(hit))
                crc = part.column("ids_crc32").to_numpy().copy()
                ids = part.column("ids")
                cut = np.flatnonzero(r[:, 4] < r[:, 0])
                kept: list = ids.to_pylist() if keep_ids else [None] * len(hit)
                for k in cut.tolist():
                    own = _wide(ids[k].as_py())[r[k, 3]:r[k, 3] + r[k, 4]].tobytes()
                    crc[k] = zlib.crc32(own)
                    if keep_ids:
                        kept[k] = _narrow(own)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(part.column("start").to_numpy() + r[:, 3]), pa.array(r[:, 4]), pa.array(crc, pa.int64()),
                    part.column("doc_tokens"), pa.array(r[:, 5] + i // r[:, 7]), pa.array(r[:, 8] + i % r[:, 7] * r[:, 4]), pa.array(kept, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return pieces.join(places.select("length", "part", "before"), ["length", "part"]).mapInArrow(task, PACKED)


def _last_not_above(lengths: np.ndarray, firsts: np.ndarray, length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Index of the last row (length, first) <= (length, number); -1: none."""
    low, high = np.searchsorted(lengths, length), np.searchsorted(lengths, length, "right")
    while True:  # bisection of all rows at once
        open_ = low < high
        if not open_.any():
            return low - 1
        mid = (low + high) // 2
        up = open_ & (firsts[np.minimum(mid, len(firsts) - 1)] <= number)
        low, high = np.where(up, mid + 1, low), np.where(open_ & ~up, mid, high)


def unpacked_ids(ids: bytes) -> list[int]:
    """The token ids of a piece from `pack(keep_ids=True)`."""
    return _wide(ids).tolist()

"""Hard negatives by exact inner products, several candidates a multiplication.

Every vector component x becomes floor(scale * x), so scores are integers and
ties are exact. Up to `lanes` candidates share one wide integer per dimension:
each component is biased to be non-negative and put into a field of its own
(Kronecker substitution). An anchor multiplies each of these integers once by
its own component; the sums over its positive and over its negative components
hold, field by field, the products of all candidates with the anchor, as no
field can run over: a field has as many bits as the largest sum of an anchor's
absolute components times the largest biased component needs. Fields are read
back as bytes, and the bias times the anchor's component sum is taken off.
Python's integers have no width limit, so scores are exact for components of
any size; scores beyond a signed 64-bit integer, and scaled
components of 2**62 and more, raise an error.

An anchor's positives are its first `n_positives` other rows of its label by
(score down, id up). For each of them, the result has the first `n_negatives`
rows of other labels whose score lies between `low` hundredths of the positive's
score and that score, both included, by (score down, id up).

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; shorter vectors count as padded with zeros;
of repeated ids the row with the smallest (label, vector) counts; an anchor
without positives, or a positive without negatives, has no rows; a negative
positive score has no band (80 hundredths of it lie above it); other columns
are ignored; empty tables give no rows.

Scale: candidates are dealt by a hash of their id into buckets of bounded size,
sorted by label inside, and written once as packed blocks. Anchors are taken in
groups of `group_rows`, a bounded broadcast; a group meets all blocks in a
map-only pass, so no candidate row is ever shuffled for an anchor, and a label
that a third of all rows have is just more blocks. The first pass reads blocks
that hold the anchors' labels, for the positives; the second all others, for the
negatives in the bands then known. A task keeps its best few rows an anchor
over all its blocks, so a pass emits anchors x tasks x a few rows, whose ranks
are cut by a partial limit before their shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.textkit import stored

SCALE = 256
LANES = 1024
BUCKET_ROWS = 16384
GROUP_ROWS = 8192
BLOCK = "ids array<long>, labels array<long>, wide array<binary>"
HARD = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def labelled_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the usable rows, components as whole numbers."""
    x = F.col(f"`{vector_col}`")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(math.inf)))
    y = lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))
    whole = F.transform(x, lambda c: F.when(F.abs(F.lit(float(scale)) * c.cast("double")) < F.lit(2.0 ** 62), y(c)).otherwise(F.raise_error(F.lit("a scaled component is beyond 2**62"))))
    return df.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), whole.alias("v"))


def pack_fields(columns: list[np.ndarray], bias: int, width: int) -> list[bytes]:
    """Of each dimension: the biased components in little-endian fields of `width` bytes."""
    out = []
    for c in columns:
        if width <= 8 and bias < 1 << 62:
            field = (c + bias).astype(np.uint64).view(np.uint8).reshape(len(c), 8)[:, :width]
            out.append(np.ascontiguousarray(field).tobytes())
        else:
            out.append(b"".join((int(x) + bias).to_bytes(width, "little") for x in c))
    return out


def read_fields(total: int, n: int, width: int) -> np.ndarray:
    """The n fields of a wide integer (as Python integers where they are long)."""
    raw = total.to_bytes(n * width, "little")
    if width in (4, 8):
        return np.frombuffer(raw, f"<u{width}").astype(np.int64) if width == 4 else np.frombuffer(raw, "<u8")
    return np.array([int.from_bytes(raw[i:i + width], "little") for i in range(0, n * width, width)], object)


def lane_scores(anchor: list[int], wide: list[int], n: int, width: int, bias: int) -> np.ndarray:
    """Inner products of one anchor with the n candidates of a block."""
    up = down = 0
    for a, w in zip(anchor, wide):
        if a > 0:
            up += a * w
        elif a < 0:
            down -= a * w
    shift = bias * sum(anchor)
    if width == 4:
        return read_fields(up, n, width) - read_fields(down, n, width) - shift
    exact = read_fields(up, n, width).astype(object) - read_fields(down, n, width).astype(object) - shift
    return exact.astype(np.int64)  # OverflowError beyond a long


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k first rows by (score down, id up)."""
    if len(score) > 4 * k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


class _Best:
    """The first k (score, id) of each key over all blocks of a task."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, key: int, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(ids):
            return
        at = _first(ids, score, self.k)
        new = [(-s, i) for s, i in zip(score[at].tolist(), ids[at].tolist())]
        old = self.held.get(key)
        self.held[key] = new if old is None else sorted(old + new)[:self.k]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for key, best in self.held.items():
            for s, i in best:
                yield key, i, -s


def _blocks(rows: DataFrame, bias: int, width: int, dims: int, lanes: int, bucket_rows: int) -> DataFrame:
    """All candidates as packed blocks: ids, labels and one wide integer per dimension."""
    n = rows.count()
    buckets = max(1, math.ceil(n / bucket_rows))

    def one(table: pa.Table) -> pa.Table:
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        size = np.array([len(v) for v in table.column("v")], np.int64)
        flat = table.column("v").combine_chunks().flatten().to_numpy()
        m = np.zeros((len(ids), dims), np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        m[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        order = np.lexsort((*m.T[::-1], labels, ids))
        order = order[np.concatenate(([True], np.diff(ids[order]) != 0))] if len(order) else order
        order = order[np.argsort(labels[order], kind="stable")]
        out = {"ids": [], "labels": [], "wide": []}
        for a in range(0, len(order), lanes):
            at = order[a:a + lanes]
            out["ids"].append(ids[at])
            out["labels"].append(labels[at])
            out["wide"].append(pack_fields(list(m[at].T), bias, width))
        return pa.table({"ids": pa.array(out["ids"], pa.list_(pa.int64())), "labels": pa.array(out["labels"], pa.list_(pa.int64())), "wide": pa.array(out["wide"], pa.list_(pa.binary()))})

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("vec_id"), F.lit(buckets)))
    return stored(dealt.groupBy("bucket").applyInArrow(one, BLOCK), "vector-blocks")


def hard_negatives(candidates: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
                   lanes: int = LANES, bucket_rows: int = BUCKET_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """For frames of labelled_vectors(): (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score)."""
    spark = candidates.sparkSession
    candidates = stored(candidates, "vectors")
    # Field width, for the whole table: the largest component and anchor.
    size = F.aggregate(F.transform("v", F.abs), F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    seen = candidates.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if seen[0] is None:
        return spark.createDataFrame([], HARD)
    anchors = stored(anchors, "anchors")
    dims, bias = max(int(seen[0]), 1), max(0, -int(seen[1] or 0))
    largest = int(anchors.agg(F.max(size)).first()[0] or 0)
    need = max(1, (largest * (int(seen[2] or 0) + bias)).bit_length())
    width = 4 if need <= 32 else 8 if need <= 64 else -(-need // 8)
    blocks = _blocks(candidates, bias, width, dims, lanes, bucket_rows)

    groups = max(1, math.ceil(anchors.count() / group_rows))
    padded = anchors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))
    grouped = stored(padded.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g")), "anchor-groups")
    found = None
    for g in range(groups):  # one pair of passes over the blocks for each group of anchors
        some = [(r["vec_id"], r["label"], list(r["v"])) for r in grouped.where(F.col("g") == g).select("vec_id", "label", "v").collect()]  # about group_rows
        part = _group(blocks, some, n_positives, n_negatives, low, width, bias)
        part = stored(part, "hard-negatives") if groups > 1 else part
        found = part if found is None else found.unionByName(part)
    return found


def _pass(blocks: DataFrame, emit, schema: str) -> DataFrame:
    """A map-only pass: emit(ids, labels, wide integers) into a _Best per task."""

    def task(batches):
        best = None
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values.to_numpy()
                labels = batch.column("labels")[i].values.to_numpy()
                wide = [int.from_bytes(w.as_buffer(), "little") for w in batch.column("wide")[i].values]
                best = emit(best, ids, labels, wide)
        if best is not None:
            rows = list(best.rows())
            for a in range(0, len(rows), 65536):
                cols = list(zip(*rows[a:a + 65536]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "id", "score"])

    return blocks.mapInArrow(task, schema)


def _group(blocks: DataFrame, anchors: list, n_positives: int, n_negatives: int, low: int, width: int, bias: int) -> DataFrame:
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(anchors)
    schema = "key long, id long, score long"
    order = [F.desc("score"), "id"]

    def positives(best, ids, labels, wide):
        best = best or _Best(n_positives)
        held = set(np.unique(labels).tolist())
        for k, (anchor, label, v) in enumerate(shared.value):
            if label in held:
                score = lane_scores(v, wide, len(ids), width, bias)
                at = np.flatnonzero((labels == label) & (ids != anchor))
                best.add(k, ids[at], score[at])
        return best

    top = Window.partitionBy("key").orderBy(*order)
    first = _pass(blocks, positives, schema).withColumn("r", F.row_number().over(top)).where(F.col("r") <= n_positives)
    chosen = sorted((r["key"], r["r"], r["id"], r["score"]) for r in first.collect())  # n_positives rows an anchor of the group
    by_anchor: dict[int, list] = {}
    for n, (k, _, _, score) in enumerate(chosen):
        by_anchor.setdefault(k, []).append((n, score, -(-low * score // 100)))
    bands = spark.sparkContext.broadcast(by_anchor)

    def negatives(best, ids, labels, wide):
        best = best or _Best(n_negatives)
        only = int(labels[0]) if (labels == labels[0]).all() else None
        for k, mine in bands.value.items():
            anchor, label, v = shared.value[k]
            if label == only:
                continue
            score = lane_scores(v, wide, len(ids), width, bias)
            at = np.flatnonzero((score >= min(b for _, _, b in mine)) & (score <= max(s for _, s, _ in mine)))
            at = at[(labels[at] != label) & (ids[at] != anchor)]
            if len(at):
                some, s = ids[at], score[at]
                for n, high, bottom in mine:
                    inside = (s >= bottom) & (s <= high)
                    best.add(n, some[inside], s[inside])
        return best

    rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    second = _pass(blocks, negatives, schema).withColumn("rank", rank).where(F.col("rank") <= n_negatives)
    names = spark.createDataFrame([(n, shared.value[k][0], i, s) for n, (k, _, i, s) in enumerate(chosen)], "key long, anchor_id long, positive_id long, positive_score long")
    return second.join(F.broadcast(names), "key").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

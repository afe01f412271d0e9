"""Substring dedup with repeated-phrase automata.

Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. A window is
`width` consecutive words of one document. Every word covered by a window
whose word sequence also starts in a document with a smaller doc_id is
removed; windows are judged on the input, not on what is left.

1. Anchors (winnowing). Of the width - GRAM + 1 GRAM-word hashes inside a
   window the smallest is its anchor, so equal windows have equal anchors. A
   maximal run of window starts with one anchor is a segment: one text per
   about five words. Anchors that `shard_rows` segments share (a frequent
   phrase in ever new surroundings) are counted first; their windows become
   segments of their own, with a hash of the whole window as anchor.
2. Bounded pre-filter. A bitmap of 2**`filter_bits` hash slots marks those that
   anchors of two documents share. It only spares segments that cannot recur;
   a full bitmap costs time, never a result.
3. Confirm. Segments are folded to (anchor, segment text, first and last doc),
   first within the map task, so a passage that a third of all documents share
   is a few rows a task, then per anchor. Anchors of one document alone are
   dropped. What remains are the recurring passages.
4. Automata. Shards of anchors get an Aho-Corasick automaton each, made of
   their recurring passages with the first document of each: the whole passage
   where an anchor has one text, its windows where it has several. Every
   distinct segment streams through the automaton of its shard, which yields
   the windows that start in an earlier document. Segments, not whole texts,
   travel to the shards, as a window can only occur in segments of its anchor.
5. The hits go back to the occurrences of their segment (a join that splits
   hot segments under AQE), are folded to window starts per document, and the
   texts are cut.

Windows are compared as text by the automata; hashes only route. A segment's
occurrences are matched to its hits by a 128-bit hash of its text.

Defined results: null or empty text has no words (and the sha256 of the empty
string); a text of fewer than `width` words loses nothing; repeated rows of
one doc_id never remove words of each other (the id is not smaller), each row
is returned, and equal rows are cut alike; rows with a null doc_id take part in nothing and lose nothing; an empty
table gives an empty result. Columns beyond id and text are kept by
`without_repeats`, whatever their names.

Scale: four passes over the text, one shuffle of the segments that may recur
and one of the text (to bring the starts to it). The bitmap (32 MB) and the
crowded anchors (at most one per `shard_rows` segments) are broadcast. An
automaton is made of about `shard_rows` distinct segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, gram_hashes, gram_rows, id_column, mix, stored, word_hashes, words

WIDTH = 13
GRAM = 5
FILTER_BITS = 28
SHARD_ROWS = 5000
_BLOCK = 20  # log2 of the slots in one block of the bitmap
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _segments(buf: np.ndarray, offs: np.ndarray, width: int, crowded: np.ndarray | None = None) -> tuple:
    """Segments of a block of rows: (anchor, row, first window as a word index
    of the block, number of windows, whether the anchor is a window's, word
    starts, word ends, first word of rows). Windows of `crowded` anchors (sorted) are segments of their own."""
    start, end, first = words(buf, offs)
    h = word_hashes(buf, start, end)
    gram = gram_hashes(h, GRAM)
    at, row = gram_rows(first, width)
    if not len(at):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none.astype(bool), start, end, first
    full = np.zeros(len(at), bool)
    low = gram[:len(gram) - (width - GRAM)].copy()
    for j in range(1, width - GRAM + 1):
        np.minimum(low, gram[j:j + len(low)], out=low)
    low = low[at]
    if crowded is not None and len(crowded):
        full = crowded[np.minimum(np.searchsorted(crowded, low), len(crowded) - 1)] == low
        if full.any():
            low = np.where(full, gram_hashes(h, width)[at], low)
    opens = np.ones(len(at), bool)
    opens[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
    opens = np.flatnonzero(opens)
    n = np.diff(np.append(opens, len(at)))
    return low[opens], row[opens], at[opens], n, full[opens], start, end, first


def _slots(anchor: np.ndarray, bits: int) -> np.ndarray:
    return (mix(anchor ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - bits)).astype(np.int64)


def survey(texts: DataFrame, width: int, bits: int, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(packed bitmap of the slots that anchors of at least two rows fall into,
    sorted anchors of at least `shard_rows` segments).

    A task sends the slots it saw as sorted, packed gaps per block of 2**20
    slots, and the anchors it saw at least eight times with their counts (in
    block -1); a block's pieces are merged one after the other."""

    def seen(batches: Iterator[pa.RecordBatch]):
        anchors, slots, twice = [], [], []
        for batch in batches:
            for part, buf, offs in blocks(batch):
                anchor, row, *_ = _segments(buf, offs, width)
                anchors.append(anchor)
                slot = np.unique((row.astype(np.int64) << bits) | _slots(anchor, bits)) & ((1 << bits) - 1)
                slot, n = np.unique(slot, return_counts=True)
                slots.append(slot.astype(np.uint32))
                twice.append(slot[n > 1].astype(np.uint32))
        if not anchors:
            return
        slot, n = np.unique(np.concatenate(slots), return_counts=True)
        multi = np.unique(np.concatenate([slot[n > 1], *twice]))
        cut = np.arange(1, max(1, 1 << max(0, bits - _BLOCK))) << _BLOCK
        rows = [(b, _pack(s), _pack(m)) for b, (s, m) in enumerate(zip(np.split(slot, np.searchsorted(slot, cut)), np.split(multi, np.searchsorted(multi, cut)))) if len(s)]
        anchor, n = np.unique(np.concatenate(anchors), return_counts=True)
        often = n >= min(8, shard_rows)
        rows.append((-1, anchor[often].tobytes(), n[often].astype(np.int64).tobytes()))
        b, s, m = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(s, pa.binary()), pa.array(m, pa.binary())], ["block", "slots", "multi"])

    size = min(1 << bits, 1 << _BLOCK)

    def merged(batches):
        now, have, two = None, np.zeros(size, bool), np.zeros(size, bool)
        often = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def done():
            value = often[0][often[1] >= shard_rows] if now == -1 else np.packbits(two, bitorder="little")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([value.tobytes()], pa.binary())], ["block", "value"])

        for batch in batches:
            for b, s, m in zip(*(batch.column(c).to_pylist() for c in ("block", "slots", "multi"))):
                if b != now:
                    if now is not None:
                        yield done()
                    now = b
                    have[:] = two[:] = False
                if b == -1:
                    anchor = np.concatenate((often[0], np.frombuffer(s, np.uint64)))
                    anchor, at = np.unique(anchor, return_inverse=True)
                    often = anchor, np.bincount(at, np.concatenate((often[1], np.frombuffer(m, np.int64))), len(anchor)).astype(np.int64)
                    continue
                s, m = _unpack(s), _unpack(m)
                two[s[have[s]]] = True
                have[s] = True
                two[m] = True
        if now is not None:
            yield done()

    parts = texts.mapInArrow(seen, "block int, slots binary, multi binary")
    parts = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block int, value binary")
    bitmap, crowded = np.zeros(max(1, (1 << bits) >> 3), np.uint8), np.zeros(0, np.uint64)
    step = max(1, size >> 3)
    for r in parts.collect():  # 2**bits bits in all, and the crowded anchors
        if r["block"] < 0:
            crowded = np.frombuffer(r["value"], np.uint64)
        else:
            bitmap[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["value"], np.uint8)
    return bitmap, crowded


def _pack(slots: np.ndarray) -> bytes:
    """Sorted slots of one block as gaps, one byte each where they fit."""
    low = slots.astype(np.int64) & ((1 << _BLOCK) - 1)
    gaps = np.diff(low, prepend=0)
    big = gaps >= 255
    body = np.where(big, 255, gaps).astype(np.uint8)
    return len(low).to_bytes(4, "little") + body.tobytes() + gaps[big].astype("<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    gaps = np.frombuffer(data, np.uint8, n, 4).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(data, "<u4", -1, 4 + n)
    return np.cumsum(gaps)


def _candidates(batches, shared, width: int, bits: int):
    """Per block: (rows, anchors, row, first word, segment texts) of the
    segments that may recur; the first word counts from the document's start."""
    bitmap, crowded = shared.value
    for batch in batches:
        for part, buf, offs in blocks(batch):
            anchor, row, at, n, single, start, end, first = _segments(buf, offs, width, crowded)
            slot = _slots(anchor, bits)
            # Window anchors of crowded phrases are not in the bitmap: all pass.
            keep = np.flatnonzero(((bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1) | single)
            data = buf.tobytes()
            a, b = start[at[keep]], end[at[keep] + n[keep] + width - 2]
            yield part, anchor[keep], row[keep], at[keep] - first[row[keep]], [b" ".join(data[x:y].split()) for x, y in zip(a.tolist(), b.tolist())]


def _folded(texts: DataFrame, shared, width: int, bits: int, memory: int = 200_000) -> DataFrame:
    """(anchor, seg, low, high): segments that may recur with the first and
    last document of the rows a task has seen (a task may send one twice)."""

    def task(batches):
        held: dict[tuple, list] = {}

        def out():
            keys, docs = list(held), list(held.values())
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary()), pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64())], ["anchor", "seg", "low", "high"])

        for part, anchor, row, _, segs in _candidates(batches, shared, width, bits):
            docs = part.column("doc_id").to_numpy()[row].tolist()
            for key, doc in zip(zip(anchor.view(np.int64).tolist(), segs), docs):
                had = held.get(key)
                if had is None:
                    held[key] = [doc, doc]
                elif doc < had[0]:
                    had[0] = doc
                elif doc > had[1]:
                    had[1] = doc
            if len(held) > memory:
                yield out()
                held.clear()
        yield out()

    return texts.mapInArrow(task, "anchor long, seg binary, low long, high long")


def _occurrences(texts: DataFrame, shared, width: int, bits: int) -> DataFrame:
    """(doc_id, body, first, h1, h2): where the segments occur."""

    def task(batches):
        for part, _, row, at, segs in _candidates(batches, shared, width, bits):
            rows = pa.array(row)
            h1, h2 = _names(segs)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("body").take(rows), pa.array(at, pa.int32()), h1, h2], ["doc_id", "body", "first", "h1", "h2"])

    return texts.mapInArrow(task, "doc_id long, body long, first int, h1 long, h2 long")


def _names(segs: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """128-bit hashes of segment texts as two columns."""
    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in segs), np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))


def _located(table: pa.Table, width: int) -> pa.RecordBatch:
    """Hits of the distinct segments of some whole anchors, sorted by anchor:
    (h1, h2, at, low), the windows that start in an earlier document of some
    occurrence and the first document of each."""
    anchor, low, high = (table.column(c).to_numpy() for c in ("anchor", "low", "high"))
    opens = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    recurs = np.minimum.reduceat(low, opens) < np.maximum.reduceat(high, opens)
    rows = np.flatnonzero(np.repeat(recurs, np.diff(np.append(opens, len(anchor)))))
    segs = table.column("seg").take(pa.array(rows)).to_pylist()
    groups: dict[int, dict[bytes, list]] = {}
    for a, seg, x, y in zip(anchor[rows].tolist(), segs, low[rows].tolist(), high[rows].tolist()):
        got = groups.setdefault(a, {}).setdefault(seg, [x, y])
        got[0], got[1] = min(got[0], x), max(got[1], y)
    automaton = ahocorasick.Automaton()
    for texts in groups.values():
        if len(texts) == 1:  # one passage: all its windows share their documents
            (seg, (x, _)), = texts.items()
            automaton.add_word(f" {seg.decode('latin-1')} ", (seg.count(b" ") + 2 - width, x))
            continue
        owner: dict[str, list[int]] = {}
        for seg, (x, y) in texts.items():
            w = seg.decode("latin-1").split(" ")
            for i in range(len(w) - width + 1):
                o = owner.setdefault(" ".join(w[i:i + width]), [x, y])
                o[0], o[1] = min(o[0], x), max(o[1], y)
        for text, (x, y) in owner.items():
            if x < y:
                automaton.add_word(f" {text} ", (1, x))
    names, at, first = [], [], []
    if len(automaton):
        automaton.make_automaton()
        for texts in groups.values():
            for seg, (_, y) in texts.items():
                line = f" {seg.decode('latin-1')} "
                hits = []
                for last, (n, x) in automaton.iter(line):
                    if x < y:
                        w = line.count(" ", 0, last) - width - n + 1
                        hits += [(i, x) for i in range(w, w + n)]
                if hits:
                    names.append(seg)
                    at.append([i for i, _ in hits])
                    first.append([x for _, x in hits])
    h1, h2 = _names(names)
    return pa.RecordBatch.from_arrays([h1, h2, pa.array(at, pa.list_(pa.int32())), pa.array(first, pa.list_(pa.int64()))], ["h1", "h2", "at", "low"])


def _bounded(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Runs of whole anchors, of about `rows` rows each, from sorted batches."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        while held.num_rows > rows:
            anchor = held.column("anchor").to_numpy()
            cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            cuts = cuts[cuts <= rows] if len(cuts) and cuts[0] <= rows else cuts[:1]
            if not len(cuts):
                break
            yield held.slice(0, int(cuts[-1]))
            held = held.slice(int(cuts[-1])).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def repeat_starts(documents: DataFrame, width: int = WIDTH, filter_bits: int = FILTER_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, body, starts): of each document (id and hash of its text) the
    first words of the windows that also start in an earlier document."""
    texts = documents.select(id_column(documents), F.col("text"), F.xxhash64("text").alias("body")).where("doc_id is not null")
    shared = texts.sparkSession.sparkContext.broadcast(survey(texts, width, filter_bits, shard_rows))

    def locate(batches):
        for table in _bounded(batches, shard_rows):
            yield _located(table, width)

    passages = _folded(texts, shared, width, filter_bits).repartition("anchor").sortWithinPartitions("anchor")
    hits = stored(passages.mapInArrow(locate, "h1 long, h2 long, at array<int>, low array<long>"), "hits")
    where = _occurrences(texts, shared, width, filter_bits).join(hits, ["h1", "h2"])
    late = F.filter(F.arrays_zip("at", "low"), lambda x: x["low"] < F.col("doc_id"))
    starts = where.select("doc_id", "body", F.transform(late, lambda x: (F.col("first") + x["at"]).cast("int")).alias("w")).where(F.size("w") > 0)
    return starts.groupBy("doc_id", "body").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("w")))).alias("starts"))


def _kept(text: str | None, starts, width: int) -> tuple[int, int, bytes]:
    """(words, words removed, the kept words joined by one space)."""
    w = (text or "").encode().split()
    if starts is None:
        return len(w), 0, b" ".join(w)
    gone = np.zeros(len(w) + 1, np.int32)
    at = np.asarray(starts)
    gone[at] += 1
    np.subtract.at(gone, at + width, 1)
    gone = np.cumsum(gone[:-1]) > 0
    return len(w), int(gone.sum()), b" ".join([x for x, g in zip(w, gone.tolist()) if not g])


def _with_starts(documents: DataFrame, **options) -> DataFrame:
    starts = repeat_starts(documents, **options).withColumnsRenamed({"doc_id": "__id", "body": "__body", "starts": "__starts"})
    return documents.join(starts, (id_column(documents) == F.col("__id")) & (F.xxhash64(documents["text"]) == F.col("__body")), "left").drop("__id", "__body")


def repeat_digest(documents: DataFrame, width: int = WIDTH, filter_bits: int = FILTER_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per document row: its words, how many are removed, sha256 of the kept words."""
    rows = _with_starts(documents.select(id_column(documents), "text"), width=width, filter_bits=filter_bits, shard_rows=shard_rows)

    def task(batches):
        for batch in batches:
            out = []
            for doc, text, starts in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("__starts")):
                n, gone, kept = _kept(text.as_py(), starts.values.to_numpy() if starts.is_valid else None, width)
                out.append((doc, n, gone, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(task, DIGEST)


def without_repeats(documents: DataFrame, width: int = WIDTH, filter_bits: int = FILTER_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The documents with their repeats removed: texts that lose words become
    their kept words joined by one space, others stay as they are."""
    rows = _with_starts(documents, width=width, filter_bits=filter_bits, shard_rows=shard_rows)
    names, schema = documents.columns, documents.schema
    at = names.index("text")

    def task(batches):
        for batch in batches:
            texts = [_kept(t.as_py(), s.values.to_numpy(), width)[2].decode() if s.is_valid else t.as_py() for t, s in zip(batch.column("text"), batch.column("__starts"))]
            cols = [batch.column(c) for c in names]
            cols[at] = pa.array(texts, batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(task, schema)

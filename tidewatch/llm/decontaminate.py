"""Benchmark decontamination: one Aho-Corasick automaton over the normalised
benchmark texts; each document is scanned once and hits are mapped back to the
offsets of its original text.

Normalising lower-cases A-Z and keeps words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
(after lower-casing: digits, a-z and everything above ASCII). A window is
`width` consecutive words of an item; an item of fewer words, but not none, is
one window. A document word inside any occurrence of a window is hit.

Defined results: null or empty text has no words; an item without words has no
window; repeated items count once per id; repeated document rows each give a
row; an empty benchmark leaves every document clean; only the id and text
columns are read, so other columns may have any name.

Scale: the documents are scanned by map tasks alone, without a shuffle. The
benchmark is measured first: up to `automaton_bytes` of item text it is one
automaton, built once in each Python worker. A larger one is dealt by a hash of
its items into shares of about that size, and the documents are scanned once for
each share, so a worker holds one automaton whatever the benchmark's size; the
shares' hits are then united for each document, of which only those with hits
travel. An automaton takes some hundred times its text in memory.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, id_column, lower, stored, words

AUTOMATON_BYTES = 2 << 20
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
HITS = "doc_id long, body long, n_words long, words array<int>, items array<string>"
SPANS = "doc_id long, item_id string, start int, end int"

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_built: dict[str, list] = {}


def _normal_words(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    buf = lower(raw)
    start, end, _ = words(buf, np.array([0, len(buf)]), _WORD)
    data = buf.tobytes()
    return [data[a:b] for a, b in zip(start, end)]


def _windows(items: list[tuple[str, str]], width: int) -> dict[str, tuple[int, list[str]]]:
    """Window text with a space on both sides -> (its words, ids of its items).
    Texts are held as latin-1 strings, one character a byte, so that automaton
    offsets are byte offsets."""
    out: dict[str, tuple[int, list[str]]] = {}
    for item, text in items:
        w = _normal_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            part = w[i:i + width]
            ids = out.setdefault((b" " + b" ".join(part) + b" ").decode("latin-1"), (len(part), []))[1]
            if not ids or ids[-1] != item:
                ids.append(item)
    return out


def _automata(key: str, packs: list[list[tuple[str, str]]], width: int) -> list:
    """The automata of one call, built once in a worker process."""
    if key not in _built:
        import ahocorasick

        _built.clear()
        made = []
        for items in packs:
            a = ahocorasick.Automaton()
            for text, value in _windows(items, width).items():
                a.add_word(text, value)
            if len(a):
                a.make_automaton()
                made.append(a)
        _built[key] = made
    return _built[key]


def _scan(automata: list, line: str, gap: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, list[str]]]]:
    """(hit flag of each word, [(first word, words, items)]). `gap`: where in
    `line` the space before each word stands."""
    hit = np.zeros(len(gap) + 1, np.int32)
    found = []
    for a in automata:
        for last, (n, ids) in a.iter(line):
            stop = int(np.searchsorted(gap, last))  # the closing space stands before this word
            hit[stop - n] += 1
            hit[stop] -= 1
            found.append((stop - n, n, ids))
    return np.cumsum(hit[:-1]) > 0, found


def _documents(batch: pa.RecordBatch, automata: list) -> Iterator[tuple]:
    """Of each row: (id, words, hits, found, first byte and end of each word of
    the block, text bytes, first byte of the row, first word of the row)."""
    for part, raw, offs in blocks(batch):
        buf = lower(raw)
        start, end, first = words(buf, offs, _WORD)
        # The block as normalised text: a space, then every word and a space.
        # Two spaces stand between rows, so that no window spans two rows.
        size = end - start
        row_of = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        at = np.concatenate(([0], np.cumsum(size + 1)))[:-1] + 1 + 2 * row_of  # of each word
        total = int(size.sum() + len(size) + 2 * len(offs) + 1)
        line = np.full(total, 0x20, np.uint8)
        if len(start):
            keep = _WORD[buf]
            line[np.repeat(at - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())] = buf[keep]
        gap = at - 1
        hit, found = _scan(automata, line.tobytes().decode("latin-1"), gap) if automata else (np.zeros(len(start), bool), [])
        by_row: dict[int, list] = {}
        for f in found:
            by_row.setdefault(int(row_of[f[0]]), []).append(f)
        sums = np.concatenate(([0], np.cumsum(hit)))
        for i, doc in enumerate(part.column("doc_id").to_pylist()):
            a, b = first[i], first[i + 1]
            yield doc, int(b - a), int(sums[b] - sums[a]), by_row.get(i, ()), start, end, raw, int(offs[i]), int(a)


def _shares(benchmark: DataFrame, limit: int) -> list:
    """A callable for each share of the benchmark that collects its items, about
    `limit` bytes of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // limit))
    share = lambda i: items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i)
    return [lambda i=i: [[tuple(r) for r in share(i).collect()]] for i in range(n)]


def _run(documents: DataFrame, share, width: int, schema: str, emit) -> DataFrame:
    """One scan of the documents with the automaton of one share."""
    items = documents.sparkSession.sparkContext.broadcast(share())
    key = uuid.uuid4().hex

    def task(batches):
        automata = _automata(key, items.value, width)
        for batch in batches:
            yield from emit(_documents(batch, automata), batch)

    return documents.mapInArrow(task, schema)


def _read(documents: DataFrame) -> DataFrame:
    return documents.select(id_column(documents), F.col("text"))


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 10, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Per document: its words, the words hit, the items with occurring windows
    (sha256 of their ids, sorted as strings, comma-joined), and whether any word is hit."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

    def emit(rows, _):
        out = []
        for doc, n, hit, found, *_ in rows:
            ids = {i for f in found for i in f[2]}
            out.append((doc, n, hit, len(ids), _digest(ids), hit > 0))
        yield _table(out, names, types)

    shares = _shares(benchmark, automaton_bytes)
    if len(shares) == 1:
        return _run(_read(documents), shares[0], width, RESULT, emit)
    united = _united(documents, shares, width)
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return united.select("doc_id", "n_words", F.size("words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         digest.alias("items_sha256"), (F.size("words") > 0).alias("contaminated"))


def _united(documents: DataFrame, shares: list, width: int) -> DataFrame:
    """(doc_id, body, n_words, words, items) of each row: the words hit and the
    items found by any share. Equal rows have equal hits, so hits are united by
    (doc_id, hash of the text) and given to every such row."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]

    def emit(rows, batch, all_rows):
        out = []
        for (doc, n, _, found, *_, at), body in zip(rows, batch.column("body").to_pylist()):
            if all_rows or found:
                words = sorted({w - at for a, m, _ in found for w in range(a, a + m)})
                out.append((doc, body, n, words, sorted({i for f in found for i in f[2]})))
        yield _table(out, ["doc_id", "body", "n_words", "words", "items"], types)

    docs = _read(documents).withColumn("body", F.xxhash64(F.coalesce("text", F.lit(""))))
    base = stored(_run(docs, shares[0], width, HITS, lambda rows, batch: emit(rows, batch, True)), "hits")
    hits = base.where(F.size("items") > 0).drop("n_words")
    for share in shares[1:]:
        hits = hits.unionByName(_run(docs, share, width, HITS, lambda rows, batch: emit(rows, batch, False)).drop("n_words"))
    unite = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    once = hits.groupBy(F.col("doc_id").alias("of"), F.col("body").alias("as")).agg(unite("words").alias("words"), unite("items").alias("items"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("body") == F.col("as"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return base.drop("words", "items").join(once, same, "left").select("doc_id", "body", "n_words", none("words", "array<int>"), none("items", "array<string>"))


def contaminated_spans(documents: DataFrame, benchmark: DataFrame, width: int = 10, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Every occurrence of a window as character offsets [start, end) of the
    document's original text, one row per item that has the window."""
    types = [pa.int64(), pa.string(), pa.int32(), pa.int32()]

    def emit(rows, _):
        for doc, _, _, found, start, end, raw, base, _ in rows:
            out = []
            for w, n, ids in found:
                a = len(raw[base:start[w]].tobytes().decode())
                b = a + len(raw[start[w]:end[w + n - 1]].tobytes().decode())
                out += [(doc, i, a, b) for i in ids]
            if out:
                yield _table(out, ["doc_id", "item_id", "start", "end"], types)

    shares = _shares(benchmark, automaton_bytes)
    found = [_run(_read(documents), share, width, SPANS, emit) for share in shares]
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, width: int = 10, min_share: float = 0.0, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The documents without those of which more than `min_share` of the words
    is hit (0: any hit). Columns stay as they are; of repeated ids each row is
    judged on its own text."""
    shares = _shares(benchmark, automaton_bytes)
    if len(shares) > 1:
        judged = _united(documents, shares, width).where(F.size("words") <= F.lit(min_share) * F.col("n_words")).select(F.col("doc_id").alias("__id"), F.col("body").alias("__body")).distinct()
        known = documents.withColumns({"__own": id_column(documents), "__text": F.xxhash64(F.coalesce("text", F.lit("")))})
        clean = known.join(judged, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__body")), "left_semi")
        return clean.select(*(F.col(f"`{c}`") for c in documents.columns))
    items = documents.sparkSession.sparkContext.broadcast(shares[0]())
    key = uuid.uuid4().hex

    def task(batches):
        automata = _automata(key, items.value, width)
        for batch in batches:
            ids = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], ["doc_id", "text"])
            keep = [hit <= min_share * n for _, n, hit, *_ in _documents(ids, automata)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(task, documents.schema)

"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Words are runs of bytes other than 0x20 and 0x09-0x0D with A-Z lower-cased;
a shingle is five consecutive words (all words, where a text has fewer). The
weight of a shingle in a text is its count times
``ln(1 + N / max(df, N / 100))``: N is the number of document rows, df the rows
having the shingle, taken from a count-min table over all documents (an upper
bound, floored at one percent, so only boilerplate is weighed down). Documents
are linked when their weighted Jaccard similarity is at least `threshold`;
classes are the connected components of the links.

1. Equal word sequences are one node, named by the smallest (doc_id, hash of
   the text) among them.
2. Each node draws `bands * rows` consistent weighted samples (Gamma(2,1)
   variables r and c and a uniform beta per shingle and sample; the shingle
   with the least c * exp(-r (t - beta) - r), t = floor(ln w / r + beta), is
   the sample, named by (shingle, t)). A band of equal samples is a bucket.
3. In a bucket every node whose samples agree by half with those of the
   smallest one, the leader, is compared with it, by the exact weighted Jaccard
   similarity of both texts. In buckets that are then of several classes, the
   shingles of each text are put in one order for all texts, rarest first. Texts
   of weights x and y are similar only if they share s / (1 + s) * (x + y); what
   comes before their first shared shingle is not shared, so each side has at
   most the rest of its weight there. Nodes meet on the shingles up to that
   bound, never more than 1 - s of their weight, and no similar pair of a bucket
   is lost. Two passes form the pairs: first every node with the smallest and
   the largest one that has the shingle, so many pairs as there are shingles;
   then, after the classes found so far, each with each where the classes
   differ. Neither thousands of near copies, which are one class by then, nor
   texts with a passage in common and enough text of their own give pairs.
4. Components by min-label propagation with pointer jumping; links and labels
   stay distributed.

With 10 bands of 3 rows a pair at 0.8 shares a bucket with probability 0.9992.

Defined results: null and empty texts have no words and are one class; rows
sharing a doc_id are one document that has all their texts, so they are of one
class; rows with a null doc_id have no class and are kept by one_per_class. That
one judges texts, not ids: a class there is linked by similarity alone, and a
text goes only if a similar one (or a chain of them) leads to one that stays. An
empty table gives an empty result; other columns are kept whatever their names.

Scale: the broadcast table has a fixed size (2 * 2**18 counters). Copies
collapse before any bucket forms, and every join is on a key AQE may split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.sizing import broadcast_if_small
from tidewatch.llm.textkit import blocks, gram_hashes, id_column, lower, mix, stored, word_hashes, words

GRAM = 5
THRESHOLD = 0.8
BANDS = 10
ROWS = 3
IDF_FLOOR = 100
_TABLE = 18  # log2 of the counters in each of the two rows of the table
_ROW = 20  # a block has fewer rows than 2**20; 44 bits of the shingle hash remain
_BLOCK = 1 << 20
_NODE = "struct<doc_id:bigint,body:bigint>"


def _shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: (shingle, row, count), by row."""
    low = lower(buf)
    start, end, first = words(low, offs)
    h = word_hashes(low, start, end)
    n = np.diff(first)
    gram = gram_hashes(h, GRAM)
    full = np.maximum(n - GRAM + 1, 0)
    row = np.repeat(np.arange(len(n)), full)
    at = np.arange(full.sum()) - np.repeat(np.concatenate(([0], np.cumsum(full)))[:-1] - first[:-1], full)
    short_value, short_row = [], []
    for k in range(1, GRAM):
        r = np.flatnonzero(n == k)
        if len(r):
            short_value.append(gram_hashes(h, k)[first[r]] ^ np.uint64(k))
            short_row.append(r)
    value = np.concatenate([gram[at], *short_value])
    row = np.concatenate([row, *short_row])
    key, count = np.unique((row.astype(np.uint64) << np.uint64(64 - _ROW)) | (value >> np.uint64(_ROW)), return_counts=True)
    return key & np.uint64((1 << (64 - _ROW)) - 1), (key >> np.uint64(64 - _ROW)).astype(np.int64), count


def _cells(shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(shingle + np.uint64(0x632BE59BD9B4E019))
    return (h >> np.uint64(64 - _TABLE)).astype(np.int64), (h & np.uint64((1 << _TABLE) - 1)).astype(np.int64) + (1 << _TABLE)


def _row_blocks(batch: pa.RecordBatch, column: str = "text"):
    """blocks() of fewer than 2**20 rows (empty texts fill no bytes)."""
    for at in range(0, batch.num_rows, (1 << _ROW) - 1):
        yield from blocks(batch.slice(at, (1 << _ROW) - 1), column, _BLOCK)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """The count-min table over all rows; its last entry is the number of rows."""
    step = 1 << 14

    def count(batches):
        table, rows = np.zeros(2 << _TABLE, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, buf, offs in _row_blocks(batch):
                shingle, _, _ = _shingles(buf, offs)
                for cells in _cells(shingle):
                    np.add(table, np.bincount(cells, minlength=len(table)), out=table)
        if rows:
            parts = [table[i:i + step].astype("<i4" if rows < 1 << 31 else "<i8").astype("<i8").tobytes() for i in range(0, len(table), step)]
            parts.append(np.array([rows], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(counts.as_buffer(), "<i8")
                sums[part] = sums[part] + counts if part in sums else counts
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    out = np.zeros((2 << _TABLE) + 1, np.int64)
    schema = "part int, counts binary"
    for r in texts.mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect():  # of a fixed size
        x = np.frombuffer(r["counts"], "<i8")
        out[r["part"] * step:r["part"] * step + len(x)] = x
    return out


def _weights(shingle: np.ndarray, count: np.ndarray, table: np.ndarray) -> np.ndarray:
    a, b = _cells(shingle)
    total = float(max(table[-1], 1))
    df = np.maximum(np.minimum(table[a], table[b]), total / IDF_FLOOR)
    return count * np.log1p(total / df)


def _unit(bits: np.ndarray, width: int) -> np.ndarray:
    return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -width)


def samples(shingle: np.ndarray, row: np.ndarray, weight: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """(n_rows, k) consistent weighted samples as 32-bit names; 0 for rows without shingles."""
    out = np.zeros((n_rows, k), np.uint32)
    if not len(shingle):
        return out
    opens = np.flatnonzero(np.diff(row, prepend=-1))
    have = row[opens]
    size = np.diff(np.append(opens, len(row)))
    log_w = np.log(weight).astype(np.float32)
    low32, low21 = np.uint64(0xFFFFFFFF), np.uint64((1 << 21) - 1)
    for j in range(k):
        x = mix(shingle ^ np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        y = mix(x ^ np.uint64(0xD6E8FEB86659FD93))
        r = -(np.log(_unit(x >> np.uint64(32), 32)) + np.log(_unit(x & low32, 32)))
        c = -np.log(np.minimum(_unit(y & low21, 21) * _unit((y >> np.uint64(21)) & low21, 21), np.float32(0.9999999)))
        beta = _unit(y >> np.uint64(43), 21)
        r = np.maximum(r, np.float32(1e-6))
        t = np.floor(log_w / r + beta)
        log_a = np.log(c) - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, opens)
        won = np.flatnonzero(log_a == np.repeat(least, size))
        _, one = np.unique(row[won], return_index=True)
        won = won[one]
        name = mix(shingle[won] ^ (t[won].astype(np.int64).view(np.uint64) << np.uint64(46)))
        out[have, j] = (name >> np.uint64(32)).astype(np.uint32)
    return out


def _signatures(texts: DataFrame, table, bands: int, rows: int) -> DataFrame:
    """(doc_id, body, digest, sig, keys): word-sequence digest, samples, band hashes."""

    def task(batches):
        df = table.value
        for batch in batches:
            for part, buf, offs in _row_blocks(batch):
                shingle, row, count = _shingles(buf, offs)
                sig = samples(shingle, row, _weights(shingle, count, df), part.num_rows, bands * rows)
                data = buf.tobytes()
                digest = [hashlib.blake2b(b" ".join(data[a:b].lower().split()), digest_size=16).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                keys = np.zeros((part.num_rows, bands), np.uint64)
                for j in range(rows):
                    keys = mix(keys ^ sig[:, j::rows].astype(np.uint64))
                flat = lambda x, t: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel(), t))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), pa.array(digest, pa.binary()), flat(sig.view(np.int32), pa.int32()), flat(keys.view(np.int64), pa.int64())], ["doc_id", "body", "digest", "sig", "keys"])

    return texts.mapInArrow(task, "doc_id long, body long, digest binary, sig array<int>, keys array<long>")


def _agreeing(a: str, b: str, least: int) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) >= least


def _compared(pairs: DataFrame, texts: DataFrame, table, threshold: float) -> DataFrame:
    """The pairs (a, b) with `hit`: weighted Jaccard >= threshold."""
    nodes, _ = broadcast_if_small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    texts = texts.join(nodes, "node", "left_semi")  # only the texts of the pairs travel
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def task(batches):
        df = table.value
        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.num_rows
                (ka, wa), (kb, wb) = (_weighted(part, column, df) for column in ("text_a", "text_b"))
                at_a = np.minimum(np.searchsorted(ka, kb), max(len(ka) - 1, 0))
                of_a = np.where(ka[at_a] == kb, wa[at_a], 0.0) if len(ka) else np.zeros(len(kb))
                row_b = _row_of(kb)
                shared = np.bincount(row_b, np.minimum(of_a, wb), n)
                joint = np.bincount(row_b, wb, n) + np.bincount(_row_of(ka), wa, n) - shared
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array((shared >= threshold * joint) & (shared > 0))], ["a", "b", "hit"])

    return both.mapInArrow(task, f"a {_NODE}, b {_NODE}, hit boolean")


def _weighted(part: pa.RecordBatch, column: str, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row and shingle in one word, weight), sorted, of the texts of a column."""
    done, cols = 0, []
    for rows, buf, offs in _row_blocks(part.select([column]), column):
        shingle, row, count = _shingles(buf, offs)
        cols.append(((row + done).astype(np.uint64) << np.uint64(64 - _ROW) | shingle, _weights(shingle, count, df)))
        done += rows.num_rows
    return tuple(np.concatenate(x) for x in zip(*cols))


def _row_of(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - _ROW)).astype(np.int64)


def _prefixes(texts: DataFrame, table, threshold: float) -> DataFrame:
    """(node, weight, prefix): the weight of a text, and its rarest shingles, each
    with the weight of the rarer ones `before` it, as far as that is no more than
    a similar text can lack."""

    def task(batches):
        df = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                key, weight = _weighted(part, "text", df)
                row, shingle = _row_of(key), key & np.uint64((1 << (64 - _ROW)) - 1)
                a, b = _cells(shingle)
                order = np.lexsort((mix(shingle), np.minimum(df[a], df[b]), row))  # one order of shingles for all texts
                row, shingle, weight = row[order], shingle[order], weight[order]
                first = np.searchsorted(row, np.arange(part.num_rows + 1))
                total = np.bincount(row, weight, part.num_rows)
                before = np.concatenate([np.cumsum(weight[x:y]) - weight[x:y] for x, y in zip(first[:-1], first[1:])])
                use = before <= ((1 - threshold) * total * (1 + 1e-9))[row]
                sizes = np.bincount(row[use], minlength=part.num_rows)
                entries = pa.StructArray.from_arrays([pa.array(shingle[use].astype(np.int64)), pa.array(before[use])], ["shingle", "before"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), entries)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(total), lists], ["node", "weight", "prefix"])

    return texts.select("node", "text").mapInArrow(task, f"node {_NODE}, weight double, prefix array<struct<shingle:bigint,before:double>>")


def _possible(r: str, m: str, threshold: float) -> Column:
    """Whether texts can be similar whose first shared shingle is this one, and
    share a bucket: neither lacks more than similar texts of their weights can."""
    of = lambda x, c: F.col(f"{x}.{c}")
    least = threshold / (1 + threshold) * (of(r, "weight") + of(m, "weight")) * (1 - 1e-9)
    return (of(r, "bands").bitwiseAND(of(m, "bands")) != 0) & (of(r, "weight") - of(r, "before") >= least) & (of(m, "weight") - of(m, "before") >= least)


def _pairs(rows: DataFrame, r: str, m: str) -> DataFrame:
    """(a, b): the distinct pairs of the nodes of `r` and `m`, smaller first."""
    r, m = F.col(f"{r}.node"), F.col(f"{m}.node")
    return rows.select(F.least(r, m).alias("a"), F.greatest(r, m).alias("b")).distinct()


def _labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of nodes with `label`, the smallest node of their class."""
    labels = components(edges).withColumnRenamed("label", "least")
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("least", "node")).drop("least")


def links(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links): members(doc_id, body, node), a row per document row,
    puts equal word sequences together under their smallest (doc_id, body);
    links(a, b) joins similar nodes, as many as the classes need."""
    texts = documents.select(id_column(documents), F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null").withColumn("body", F.xxhash64("text"))
    table = texts.sparkSession.sparkContext.broadcast(document_frequencies(texts))
    signed = stored(_signatures(texts, table, bands, rows), "signatures")
    nodes = signed.groupBy("digest").agg(F.min(F.struct("doc_id", "body")).alias("node"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    nodes = stored(nodes, "nodes")
    members = stored(signed.select("doc_id", "body", "digest").join(nodes.select("digest", "node"), "digest").select("doc_id", "body", "node"), "members")
    placed = nodes.where(F.exists("sig", lambda x: x != 0)).select("node", F.posexplode("keys").alias("band", "key"))
    bucket, least = ["band", "key"], (bands * rows + 1) // 2
    lead = placed.groupBy(*bucket).agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a < high").drop("high")
    # A leader's key names its bucket of a band, so a bit per band tells the buckets two members share.
    inside = placed.join(lead, bucket).groupBy("a", "node").agg(F.bit_or(F.expr("shiftleft(1L, band)")).alias("bands"))
    sig = nodes.select("node", "sig")
    inside = inside.join(sig, "node").join(sig.select(F.col("node").alias("a"), F.col("sig").alias("lead_sig")), "a")
    inside = stored(inside.select("a", "node", "bands", _agreeing("sig", "lead_sig", least).alias("alike")), "buckets")
    pairs = inside.where("alike and a < node").select("a", F.col("node").alias("b"))
    wanted, _ = broadcast_if_small(inside.select("node").distinct())
    # Rows of one id with equal texts are one row here.
    bodies = texts.select(F.struct("doc_id", "body").alias("node"), "text").join(wanted, "node", "left_semi")
    bodies = stored(bodies.groupBy("node").agg(F.first("text").alias("text")), "bodies")
    facing = stored(_compared(pairs, bodies, table, threshold), "facing")

    inside = _labelled(inside.drop("alike"), facing.where("hit"))
    several = inside.groupBy("a").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("a")
    open_buckets = stored(inside.join(several, "a", "left_semi"), "open-buckets")
    inner, _ = broadcast_if_small(open_buckets.select("node").distinct())
    prefixes = stored(_prefixes(bodies.join(inner, "node", "left_semi"), table, threshold), "prefixes")
    entries = open_buckets.join(prefixes, "node").select("a", "node", "label", "bands", "weight", F.explode("prefix").alias("p"))
    entries = entries.select(F.xxhash64("a.doc_id", "a.body", "p.shingle").alias("key"), "label", F.struct("node", "bands", "weight", F.col("p.before").alias("before")).alias("r"))
    # Every member against the first and the last one that has the shingle, as far as they are of other classes.
    at = Window.partitionBy("key")
    for end in (F.min, F.max):
        entries = entries.withColumn(end.__name__, end(F.struct("r", "label")).over(at))
    mixed = entries.withColumns({"low": F.min("label").over(at), "high": F.max("label").over(at), "n": F.count(F.lit(1)).over(at)}).where("low < high")
    mixed = stored(mixed.drop("low", "high"), "shared-shingles")
    ends = [_pairs(mixed.where(F.col("label") != F.col(f"{end}.label")).where(_possible("r", f"{end}.r", threshold)), "r", f"{end}.r") for end in ("min", "max")]
    pairs = stored(ends[0].unionByName(ends[1]).distinct().join(facing.select("a", "b"), ["a", "b"], "left_anti"), "pairs-of-ends")
    ended = stored(_compared(pairs, bodies, table, threshold), "ends")
    known = facing.unionByName(ended)

    # What lies between the two and is still of several classes, each with each.
    between = mixed.where("n > 3 and r.node != min.r.node and r.node != max.r.node")
    mixed = _labelled(between.select("key", "r", F.col("r.node").alias("node")), known.where("hit")).drop("node")
    mixed = mixed.withColumns({"low": F.min("label").over(at), "high": F.max("label").over(at)}).where("low < high")
    mixed = stored(mixed.drop("high"), "mixed-shingles")
    upper = mixed.where("low < label").select("key", F.col("r").alias("m"), F.col("label").alias("above"))
    both = mixed.select("key", "label", "r").join(upper, "key").where((F.col("label") < F.col("above")) & _possible("r", "m", threshold))
    pairs = stored(_pairs(both, "r", "m").join(known.select("a", "b"), ["a", "b"], "left_anti"), "pairs-between")
    rest = stored(_compared(pairs, bodies, table, threshold), "rest")
    edges = known.unionByName(rest).where("hit").select("a", "b")
    return members, stored(edges, "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for nodes with edges."""
    both = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near"))), "edges")
    labels = stored(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), "label"), "near").select("node", "label")
        least = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(least.join(jump, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label < old").limit(1).count()
        labels = new
        if not changed:
            return labels


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document row: doc_id, class_id (the smallest doc_id of its class) and kept."""
    members, edges = links(documents, threshold, bands, rows)
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a < high")
    of_one_id = members.join(several, "doc_id").where("node > a").select("a", F.col("node").alias("b")).distinct()
    classes = _labelled(members, edges.unionByName(of_one_id)).select("doc_id", F.col("label.doc_id").alias("class_id"))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def one_per_class(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The documents, one row of each class of similar texts (that of the
    smallest doc_id; of its rows, the one whose text hash is least); rows with a
    null doc_id stay."""
    members, edges = links(documents, threshold, bands, rows)
    out = _labelled(members, edges).where(F.struct("doc_id", "body") != F.col("label"))
    out = out.select(F.col("doc_id").alias("__id"), F.col("body").alias("__text")).distinct()
    known = documents.withColumns({"__id": id_column(documents), "__text": F.xxhash64(F.coalesce("text", F.lit("")))})
    rest = known.where("__id is not null").join(out, ["__id", "__text"], "left_anti")
    turn = Window.partitionBy("__id", "__text").orderBy("__text")
    one = rest.withColumn("__turn", F.row_number().over(turn)).where("__turn = 1")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return one.select(*columns).unionByName(known.where("__id is null").select(*columns))

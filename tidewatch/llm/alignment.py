"""Alignment of two tokenizers over the bytes of each document.

Vocabulary A encodes a space and the text; vocabulary B encodes the text and
adds the space itself. Both give the whole text as tokens whose bytes, joined,
must be the space and the text; a document where either differs has no tokens.

A space-marked token is one whose first byte is a space. Where a space-marked
token of A and one of B begin at the same byte, the tokens before both have just
ended there: such verified anchors cut a document into windows, pairs of id
tuples that are aligned on their own. Windows repeat, so their alignments are
memoised. An id tuple spells its bytes and the bytes give the tuple, so the memo
is keyed by the bytes, a chunk of one or a few windows (tokens.py), which are at
hand before any id is:

- groups: the byte offsets where an A and a B token both end cut the window;
- links: all pairs of an A and a B token occurrence whose byte ranges overlap.

Corpus-wide, an id pair's count is the number of documents that hold it linked.

Defined results: null and empty texts have no tokens, zeros and an empty
digest; rows without a doc_id, repeated ids and repeated rows are documents of
their own, each counting; special tokens' strings are plain text; ties for an A
id's highest count are all best; other columns are ignored; an empty table gives
no rows.

Scale: one pass tokenises and aligns. Ids are made once per distinct chunk of a
worker (chunks end where a token of both vocabularies must begin, so chunk ends
are anchors), the windows of new chunks are aligned all at once, and a block of
documents is then gathers and sums over chunk codes.
Each document keeps its distinct id pairs with their link numbers; the pass is
written once. Counts of a pair are summed inside tasks before their shuffle and
are at most (size of A) x (size of B) rows. They return to the documents in
shards of at most `shard_pairs` pairs, each a bounded broadcast to a map-only
pass, so no document and no frequent pair is ever shuffled; with more than one
shard the documents' partial sums are added up.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, id_column, stored
from tidewatch.llm.tokens import ChunkMemo, Lists, byte_level_bytes, byte_level_lists, chunk_starts, pieces

SHARD_PAIRS = 1 << 22
FLUSH_PAIRS = 1 << 20
ALIGN_BYTES = 4 << 20  # text of a block
ALIGNED = "part int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"
_B_IDS = 1 << 24  # an id pair is a * _B_IDS + b


def align(a_end: np.ndarray, b_end: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group of each A token, group of each B token, A index and B index of each
    link, last A token of each group) of two token rows over the same bytes,
    given where each token ends and the anchors, offsets where both rows begin a
    token: every window between two of them is aligned on its own.

    Inside a window, two neighbouring ends of either row bound a piece of one A
    and one B token, and two tokens that overlap share exactly one such piece."""
    n = int(a_end[-1]) if len(a_end) else 0
    in_a, in_b = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    in_a[a_end], in_b[b_end] = True, True
    shared = in_a & in_b
    assert shared[anchors[anchors > 0]].all()  # an anchor is a verified shared end
    before_a, before_b, cuts = np.cumsum(in_a), np.cumsum(in_b), np.cumsum(shared)
    ends = np.flatnonzero(in_a | in_b)
    return (cuts[a_end] - shared[a_end], cuts[b_end] - shared[b_end],
            before_a[ends] - in_a[ends], before_b[ends] - in_b[ends], before_a[np.flatnonzero(shared)] - 1)


def digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal text of 0..n-1: (bytes with room for a separator, lengths)."""
    width = len(str(max(n - 1, 0)))
    text = np.zeros((n, width + 1), np.uint8)
    size = np.zeros(n, np.int64)
    for i in range(n):
        t = str(i).encode()
        text[i, :len(t)] = list(t)
        size[i] = len(t)
    return text, size


class Side:
    """One vocabulary: its encoder, and the bytes, lengths and marks of its ids."""

    def __init__(self, encode, table: list[bytes], joined: int):
        self.encode, self.table, self.joined = encode, table, joined
        self.size = np.array(list(map(len, table)), np.int64)
        self.marked = np.array([t[:1] == b" " for t in table])

    def tokens(self, texts: list[bytes], skip: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of each). Neighbours that may be cut apart
        again are encoded as one text; `skip`: bytes that the vocabulary adds
        to the front of a text by itself."""
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        buf = np.frombuffer(b"".join(texts), np.uint8)
        at = np.cumsum(n) - n
        joined = np.zeros(len(buf), bool)
        joined[chunk_starts(buf, np.array([0, len(buf)]))] = True
        new = np.flatnonzero(~joined[at] | (np.arange(len(at)) % self.joined == 0))
        run_at = np.append(at[new], len(buf)).tolist()
        raw = buf.tobytes()
        ids = self.encode([raw[i + skip:j].decode() for i, j in zip(run_at, run_at[1:])])
        count = np.zeros(len(texts), np.int64)
        flat = np.array(list(chain.from_iterable(ids)), np.int64)
        # Where every chunk's end is a token's end, the tokens go to their chunks.
        ends = np.cumsum(self.size[flat])
        if len(flat) and ends[-1] == len(buf):
            last = np.searchsorted(ends, at + n)
            if np.array_equal(ends[last], at + n):
                return flat, np.diff(np.concatenate(([-1], last)))
        out = []
        bounds = [*new.tolist(), len(texts)]
        for k, (i, j) in enumerate(zip(bounds, bounds[1:])):  # some texts are not spelled by their tokens
            own = ids[k:k + 1] if j - i == 1 else self.encode([t[skip:].decode() for t in texts[i:j]])
            out += own
            count[i:j] = [len(x) for x in own]
        return np.array(list(chain.from_iterable(out)), np.int64), count

    def differ(self, ids: np.ndarray, n: np.ndarray, chunks: list[bytes]) -> np.ndarray:
        """Which chunks their tokens' bytes do not spell."""
        row = np.repeat(np.arange(len(n)), n)
        want = np.fromiter(map(len, chunks), np.int64, len(chunks))
        wrong = np.bincount(row, weights=self.size[ids], minlength=len(n)).astype(np.int64) != want
        sound = ~wrong
        spelled = np.frombuffer(b"".join(map(self.table.__getitem__, ids[sound[row]].tolist())), np.uint8)
        text = np.frombuffer(b"".join(chunks) if sound.all() else b"".join(c for c, ok in zip(chunks, sound) if ok), np.uint8)
        wrong[np.flatnonzero(sound)[np.unique(np.repeat(np.arange(int(sound.sum())), want[sound])[spelled != text])]] = True
        return wrong


class Aligner:
    """Alignments of chunks, with their windows memoised by id tuples."""

    def __init__(self, a_path: str, b_path: str):
        encode_b, table_b = pieces(b_path)
        # Calls cost more than text for A, long texts more than calls for B.
        self.a, self.b = Side(byte_level_lists(a_path), byte_level_bytes(a_path), 2000), Side(encode_b, table_b, 1)
        self.digits, self.digit_size = digits(max(len(self.a.table), len(self.b.table)))
        self.memo = ChunkMemo(self._reset, self._chunks)

    def _reset(self) -> None:
        self.links = Lists()  # of each chunk: the pair index of each link
        self.text: list[bytes] = []  # of each chunk: its groups, each with a closing ";"
        self.table = np.zeros((0, 4), np.int64)  # of each chunk: n_a, n_b, n_groups, whether its bytes agree
        self.pairs = np.zeros(0, np.int64)
        self.pair_at: dict[int, int] = {}

    def _chunks(self, new: list[bytes]) -> None:
        """Tokenise new chunks and align them, window by window, all at once."""
        a, n_a = self.a.tokens(new, 0)
        b, n_b = self.b.tokens(new, 1)
        wrong = self.a.differ(a, n_a, new) | self.b.differ(b, n_b, new)
        if wrong.any():
            a, b = a[np.repeat(~wrong, n_a)], b[np.repeat(~wrong, n_b)]
            n_a, n_b = np.where(wrong, 0, n_a), np.where(wrong, 0, n_b)
        # Byte positions run on over all chunks, the same for A and B.
        size_a, size_b = self.a.size[a], self.b.size[b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        anchor = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, bool)
        anchor[(end_a - size_a)[self.a.marked[a]]] = True
        both = np.zeros(len(anchor), bool)
        both[(end_b - size_b)[self.b.marked[b]]] = True
        anchor &= both
        group_a, group_b, link_a, link_b, bound = align(end_a, end_b, np.flatnonzero(anchor))
        row_a, row_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        n_groups = np.bincount(row_a[bound], minlength=len(new))
        self.table = np.concatenate((self.table, np.stack([n_a, n_b, n_groups, ~wrong], axis=1)))
        self.links.add_flat(self._pair_index(a[link_a] * _B_IDS + b[link_b]), np.bincount(row_a[link_a], minlength=len(new)))
        # Text: of each group its A ids, then its B ids, each id with what follows it.
        total, groups = len(a) + len(b), int(n_groups.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        ids, after = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        after[at_a[np.cumsum(in_a) - 1]] = ord("|")
        after[at_b[np.cumsum(in_b) - 1]] = ord(";")
        text, size = self.digits[ids], self.digit_size[ids]
        text[np.arange(total), size] = after
        flat = text[np.arange(text.shape[1]) <= size[:, None]].tobytes()
        end = np.concatenate(([0], np.cumsum(size + 1)))[np.cumsum(n_a + n_b)].tolist()
        self.text += [flat[i:j] for i, j in zip([0, *end], end)]

    def _pair_index(self, pairs: np.ndarray) -> np.ndarray:
        distinct, at = np.unique(pairs, return_inverse=True)
        known = self.pair_at
        fresh = [p for p in distinct.tolist() if p not in known]
        for p in fresh:
            known[p] = len(known)
        self.pairs = np.concatenate((self.pairs, np.array(fresh, np.int64)))
        return np.fromiter(map(known.__getitem__, distinct.tolist()), np.int64, len(distinct))[at]

    def documents(self, buf: np.ndarray, offs: np.ndarray):
        """(n_a, n_b, n_groups, n_links, digest, pairs, links of each pair) of each row of a block."""
        codes, first = self.memo.codes(buf, offs)
        n_docs = len(offs) - 1
        row = np.repeat(np.arange(n_docs), np.diff(first))
        table = self.table[codes]
        good = np.ones(n_docs, bool)
        good[row[table[:, 3] == 0]] = False
        n = [np.bincount(row, weights=table[:, k], minlength=n_docs).astype(np.int64) * good for k in range(3)]
        n_links = np.bincount(row, weights=self.links.size(codes), minlength=n_docs).astype(np.int64) * good
        # Links of each (document, pair).
        pairs = max(len(self.pairs), 1)
        key = np.repeat(row, self.links.size(codes)) * pairs + self.links.take(codes)
        key.sort()
        begin = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), np.diff(key) != 0)))
        links = np.diff(np.append(begin, len(key))).astype(np.int32)
        key = key[begin]
        doc, pair = key // pairs, self.pairs[key % pairs] if len(key) else key
        bound = np.searchsorted(doc, np.arange(n_docs + 1))
        text, code_list = self.text, codes.tolist()
        for i in range(n_docs):
            a, b = first[i], first[i + 1]
            if not good[i] or a == b:
                yield 0, 0, 0, 0, "", b"", b""
                continue
            digest = hashlib.sha256(b"".join([text[c] for c in code_list[a:b]])[:-1]).hexdigest()
            x, y = bound[i], bound[i + 1]
            yield int(n[0][i]), int(n[1][i]), int(n[2][i]), int(n_links[i]), digest, pair[x:y].tobytes(), links[x:y].tobytes()


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner a worker process, kept between its tasks."""
    return Aligner(a_path, b_path)


def aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of each document: token, group and link numbers, the digest of its groups,
    and its distinct id pairs with their links; written to the shared folder."""

    def task(batches):
        mine = aligner(a_path, b_path)
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            spaced = pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise("", text, " "))
            for rows, buf, offs in blocks(pa.RecordBatch.from_arrays([batch.column("doc_id"), spaced], ["doc_id", "text"]), limit=ALIGN_BYTES):
                out = list(zip(*mine.documents(buf, offs)))
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), rows.column("doc_id"),
                    *(pa.array(out[k], pa.int64()) for k in range(4)), pa.array(out[4], pa.string()), pa.array(out[5], pa.binary()), pa.array(out[6], pa.binary())],
                    names=["part", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])
                row += n

    return stored(documents.select(id_column(documents), F.col("text")).mapInArrow(task, ALIGNED), "alignment")


def _joined(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, number of each row) of a column of packed arrays."""
    size = np.array(pc.binary_length(column).to_pylist(), np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), size


def pair_counts(docs: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that hold each id pair linked, and whether
    that is the highest count of its A id."""

    def task(batches):
        held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                values, _ = _joined(batch.column("pairs").slice(a, 4096), np.int64)
                new, times = np.unique(values, return_counts=True)
                both = np.concatenate((held, new))
                held, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, weights=np.concatenate((n, times)), minlength=len(held)).astype(np.int64)
                if len(held) > FLUSH_PAIRS:
                    yield from _pairs(held, n)
                    held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield from _pairs(held, n)

    def _pairs(held, n):
        for a in range(0, len(held), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(held[a:a + 65536]), pa.array(n[a:a + 65536])], ["pair", "n"])

    total = docs.select("pairs").mapInArrow(task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    total = stored(total, "pair-counts")
    top = total.groupBy(F.expr(f"pair div {_B_IDS}").alias("a")).agg(F.max("n").alias("top"))
    return stored(total.join(top, F.expr(f"pair div {_B_IDS}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-best")


def with_counts(docs: DataFrame, counts: DataFrame, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """Documents with n_best and count_sum, from the counts in bounded shards."""
    spark = docs.sparkSession
    shards = max(1, -(-counts.count() // shard_pairs))
    schema = "part int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    found = None
    for s in range(shards):
        own = counts.where(F.pmod(F.xxhash64("pair"), F.lit(shards)) == s).orderBy("pair").toArrow()  # about shard_pairs rows
        shared = spark.sparkContext.broadcast(tuple(own.column(k).to_numpy() for k in ("pair", "n", "best")))

        def task(batches, shared=shared):
            pair, n, best = shared.value
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    part = batch.slice(a, 4096)
                    values, size = _joined(part.column("pairs"), np.int64)
                    links, _ = _joined(part.column("links"), np.int32)
                    links = links.astype(np.int64)
                    at = np.minimum(np.searchsorted(pair, values), max(len(pair) - 1, 0))
                    here = pair[at] == values if len(pair) else np.zeros(len(values), bool)
                    at = at[here]
                    sums = []
                    for w in (links[here] * best[at], links[here] * n[at]):
                        full = np.zeros(len(values) + 1, np.int64)
                        full[1:][here] = w
                        full = np.cumsum(full)
                        end = np.cumsum(size)
                        sums.append(full[end] - full[end - size])
                    keep = ["part", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *map(pa.array, sums)], names=[*keep, "n_best", "count_sum"])

        one = docs.mapInArrow(task, schema)
        found = one if found is None else found.unionByName(one)
    if shards > 1:
        rest = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        found = found.groupBy("part", "row").agg(*(F.first(c).alias(c) for c in rest), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_tokenizers(documents: DataFrame, a_path: str, b_path: str, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = aligned(documents, a_path, b_path)
    return with_counts(docs, pair_counts(docs), shard_pairs)


def id_map(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The token map that the corpus gives: (a, b, n) for every best pair."""
    best = pair_counts(aligned(documents, a_path, b_path)).where("best")
    return best.select(F.expr(f"pair div {_B_IDS}").cast("int").alias("a"), (F.col("pair") % _B_IDS).cast("int").alias("b"), "n")

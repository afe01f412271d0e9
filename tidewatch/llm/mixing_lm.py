"""Language model scoring by online logistic context mixing.

Texts are lower-cased (A-Z) and cut into tokens: words (runs of bytes other
than 0x20 and 0x09-0x0D), then one end token. The model codes each token by
binary decisions:

- one escape bit: is the token among the `dictionary` most frequent training
  tokens (seen at least twice)?
- a dictionary token: the bits of its frequency rank, most significant first;
- any other token: the bits of its bytes and of a closing space (the end token
  is the closing space alone).

Every bit is predicted in several contexts (rank prefix with and without the
class; byte prefix with position, class and last byte, last two, three and
five bytes, the longer ones hashed into fixed tables). The predictions, in the
logistic domain, are summed with weights chosen by a gate (position, bit and
how often the longest context was seen), and refined by an adaptive
probability map from (context, predicted logit) to the observed frequency. The
class of a token is the cluster of the latest very frequent word before it in
the text: the 512 most frequent words are clustered by which of them follow
each other, which separates languages.

Learning. Training documents fall into two folds by a hash of their id.
Context counts of fold A predict fold B while the weights follow the gradient
online, bit by bit in mini-batches, in every partition of the aggregated
tokens; partitions are averaged by their mass. The map is then filled the same
way. Scoring uses the counts of both folds. The probabilities of the bits of
all tokens multiply to a proper (sub-)distribution over texts.

The base score is the unigram sum of log10((c + 0.5) / (N + 0.5 (V + 1))).

Defined results: null text is empty text (one end token); rows with a null
doc_id are scored as not held out and not learnt from; repeated rows each
count in training and each get a row; without training rows all counts are
zero and bits cost one half; an empty table gives an empty result.

Scale: token counts, class-token counts and neighbour counts are map-side
sums over the whole corpus. Frequent tokens are scored in the map task from
tables of fixed size; only the others travel: they are joined to the counts by
word (none of them is frequent, so no key is hot) and summed per document.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, crc_remainder, id_column, mix, stored

DICTIONARY = 1 << 17
SIGNALS = 512
CLASSES = 8
_DEPTH = 17
#: Tables of the byte contexts in one slot array: (offset, log2 size).
_SIZES = (12, 20, 19, 20, 21)
_OFFSETS = np.concatenate(([0], np.cumsum([1 << s for s in _SIZES])))
SLOTS = int(_OFFSETS[-1])
_GATES = 8 * 8 * 4
_CHUNK = 1 << 18  # decisions handled at once
_TEXT = 1 << 20  # bytes of text whose tokens are Python objects at once
_HELD = 50_000  # different tokens that a task counts before it hands them on
_ROWS = 1 << 15  # rows of a batch
_LN10 = np.log(10.0)


def tokens_of(text: str | None) -> list[bytes]:
    out = (text or "").encode().lower().split()
    out.append(b"")
    return out


def _texts(batch: pa.RecordBatch):
    for part, _, _ in blocks(batch, limit=_TEXT):
        yield part, part.column("text").to_pylist()


def token_counts(train: DataFrame) -> DataFrame:
    """(word, n): how often each token occurs; the end token is empty."""

    def task(batches):
        counts: Counter = Counter()

        def out():
            found = iter(counts.items())
            while some := list(islice(found, _ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

        for batch in batches:
            for _, texts in _texts(batch):
                for t in texts:
                    counts.update(tokens_of(t))
                if len(counts) > 2 * _HELD:  # bounded memory; the shuffle adds up
                    yield from out()
                    counts.clear()
        yield from out()

    return train.select("text").mapInArrow(task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """The dictionary, the clusters of its first words, and their lookups."""

    def __init__(self, words: list[bytes], counts: list[int], clusters: np.ndarray | None = None):
        self.words, self.counts = words, np.array(counts, float)
        self.clusters = np.zeros(min(SIGNALS, len(words)), np.int64) if clusters is None else clusters

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def classes(self, ids: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Class of each token; `opens`: index of the first token of its text."""
        if not len(ids):
            return np.zeros(0, np.int64)
        signal = (ids >= 0) & (ids < len(self.clusters))
        if len(self.words):  # the end token tells nothing
            signal &= np.array([len(w) > 0 for w in self.words[:SIGNALS]] + [False])[np.where(signal, ids, -1)]
        last = np.maximum.accumulate(np.where(signal, np.arange(len(ids)), -1))
        last = np.append(-1, last[:-1])
        return np.where(last >= opens, self.clusters[np.clip(ids[last], 0, max(len(self.clusters) - 1, 0))] + 1 if len(self.clusters) else 0, 0)


def _flat(texts: list, index: dict[bytes, int]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of all texts, their ids or -1, index of the first token of their text, tokens of each text)."""
    words: list[bytes] = []
    sizes = []
    for t in texts:
        w = tokens_of(t)
        sizes.append(len(w))
        words += w
    n = np.array(sizes, np.int64)
    get = index.get
    return words, np.array([get(w, -1) for w in words], np.int64), np.repeat(np.cumsum(n) - n, n), n


def _sum_parts(rows: DataFrame, size: int, step: int = 1 << 14) -> np.ndarray:
    """Sum of equally long float vectors sent as (part, values) pieces."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column("part").to_pylist(), batch.column("values")):
                x = np.frombuffer(values.as_buffer())
                sums[part] = sums[part] + x if part in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "values"])

    out = np.zeros(size)
    for r in rows.repartition("part").mapInArrow(add, "part int, values binary").collect():  # `size` numbers
        x = np.frombuffer(r["values"])
        out[r["part"] * step:r["part"] * step + len(x)] = x
    return out


def _pieces(x: np.ndarray, step: int = 1 << 14) -> pa.RecordBatch:
    parts = [(i // step, x[i:i + step]) for i in range(0, len(x), step)]
    parts = [(i, p) for i, p in parts if p.any()]
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([np.ascontiguousarray(p, float).tobytes() for _, p in parts], pa.binary())], ["part", "values"])


def _clusters(train: DataFrame, lexicon: Lexicon, k: int = CLASSES) -> np.ndarray:
    """Cluster of each of the most frequent words, by the frequent words that follow it."""
    m = len(lexicon.clusters)
    if not m:
        return lexicon.clusters
    index = {w: i for i, w in enumerate(lexicon.words[:m]) if w}

    def task(batches):
        seen = np.zeros(m * m)
        for batch in batches:
            for _, texts in _texts(batch):
                _, ids, opens, _ = _flat(texts, index)
                at = np.flatnonzero(ids >= 0)
                a, b = at[:-1], at[1:]
                same = opens[a] == opens[b]
                seen += np.bincount(ids[a[same]] * m + ids[b[same]], minlength=m * m)
        yield _pieces(seen)

    near = _sum_parts(train.select("text").mapInArrow(task, "part int, values binary"), m * m).reshape(m, m)
    x = np.sqrt((near + near.T) / np.maximum((near + near.T).sum(1, keepdims=True), 1))
    centre = [x[0]]
    for _ in range(1, k):  # furthest first, weighted by frequency
        far = np.min([1 - x @ c for c in centre], axis=0) * np.sqrt(lexicon.counts[:m])
        centre.append(x[int(far.argmax())])
    centres = np.array(centre)
    own = np.zeros(m, np.int64)
    for _ in range(20):
        own = (x @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (own == c).any():
                v = (x[own == c] * lexicon.counts[:m][own == c, None]).sum(0)
                centres[c] = v / max(np.linalg.norm(v), 1e-12)
    return own


def _class_counts(train: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(cls, idx, word, a, b): tokens by class in the two folds; idx -1: not in the dictionary."""

    def task(batches):
        index = lexicon.index()
        d = max(len(index), 1)
        own = np.zeros((2, (CLASSES + 1) * d), np.int64)
        rare: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            found = chain(rare[0], (k for k in rare[1] if k not in rare[0]))
            while keys := list(islice(found, _ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([-1] * len(keys), pa.int32()), pa.array([k[1] for k in keys], pa.binary()), pa.array([rare[0][k] for k in keys], pa.int64()), pa.array([rare[1][k] for k in keys], pa.int64())], ["cls", "idx", "word", "a", "b"])

        for batch in batches:
            for part, texts in _texts(batch):
                words, ids, opens, n = _flat(texts, index)
                cls = lexicon.classes(ids, opens)
                fold = np.repeat(part.column("fold").to_numpy(), n)
                for f in (0, 1):
                    at = np.flatnonzero((fold == f) & (ids >= 0))
                    own[f] += np.bincount(cls[at] * d + ids[at], minlength=own.shape[1])
                    at = np.flatnonzero((fold == f) & (ids < 0))
                    rare[f].update(zip(cls[at].tolist(), [words[i] for i in at.tolist()]))
                if len(rare[0]) + len(rare[1]) > _HELD:
                    yield from out()
                    rare[0].clear()
                    rare[1].clear()
        yield from out()
        seen = np.flatnonzero(own.any(0))
        for i in range(0, len(seen), _ROWS):
            at = seen[i:i + _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(at // d, pa.int32()), pa.array(at % d, pa.int32()), pa.array([b""] * len(at), pa.binary()), pa.array(own[0, at]), pa.array(own[1, at])], ["cls", "idx", "word", "a", "b"])

    counted = train.select("text", "fold").mapInArrow(task, "cls int, idx int, word binary, a long, b long")
    return counted.groupBy("cls", "idx", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _hash(x: np.ndarray, c0: np.ndarray, table: int) -> np.ndarray:
    h = mix(x * np.uint64(0x9E3779B97F4A7C15) + c0.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(table))
    return (h >> np.uint64(64 - _SIZES[table])).astype(np.int64)


def spell(words: list[bytes], cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The byte decisions of tokens: (slots (5, m), bit, gate without
    confidence, partial byte, token)."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    size = np.array([len(w) + 1 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    before = [np.where(pos >= k, np.append(np.zeros(k, np.int64), data[:-k] if k < len(data) else data[:0])[:len(data)], 0) for k in range(1, 6)]
    two = (before[1] << 8) | before[0]
    three = (before[2] << 16) | two
    five = (((before[4] << 8) | before[3]) << 24) | three
    bit = np.arange(8)
    sym = data[:, None]
    c0 = (1 << bit) | (sym >> (8 - bit))
    col = lambda x: np.broadcast_to(x[:, None], c0.shape)
    slots = np.stack([
        (np.minimum(col(pos), 15) << 8 | c0),
        _OFFSETS[1] + (col(cls[owner]) << 16 | col(before[0]) << 8 | c0),
        _OFFSETS[2] + _hash(col(two).astype(np.uint64), c0, 2),
        _OFFSETS[3] + _hash(col(three).astype(np.uint64), c0, 3),
        _OFFSETS[4] + _hash(col(five).astype(np.uint64), c0, 4),
    ]).reshape(5, -1)
    gate = (np.minimum(col(pos), 7) * 8 + bit).ravel()
    return slots, ((sym >> (7 - bit)) & 1).ravel(), gate, c0.ravel(), np.repeat(owner, 8)


def _word_chunks(words: list[bytes]):
    """Ranges of words of at most _CHUNK decisions (or one word)."""
    at = size = 0
    for i, w in enumerate(words):
        more = 8 * (len(w) + 1)
        if size and size + more > _CHUNK:
            yield at, i
            at, size = i, 0
        size += more
    if at < len(words):
        yield at, len(words)


def _table(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logit of each slot, how often it was seen: 0, 1-3, 4-31, more)."""
    logit = np.clip(np.log((n1 + 0.3) / (n0 + 0.3)), -10, 10).astype(np.float32)
    n = n0 + n1
    return logit, ((n >= 1).astype(np.uint8) + (n >= 4) + (n >= 32)).astype(np.uint8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Mixer:
    """Gated weights over the context logits, then the adaptive map."""

    def __init__(self, gates: int, inputs: int, maps: int):
        self.weight = np.full((gates, inputs), 0.35 if inputs > 2 else 0.5)
        self.mass, self.square = np.zeros(gates), np.zeros((gates, inputs))
        self.map = np.zeros((maps, 33))  # logits; filled by refine()
        self.ready = False

    def mixed(self, logits: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("im,mi->m", logits, self.weight[gate]), -12, 12)

    def learn(self, logits: np.ndarray, gate: np.ndarray, bit: np.ndarray, n: np.ndarray, rate: float = 0.02, batch: int = 2048) -> None:
        """Online gradient steps on the coding cost, a mini-batch at a time,
        each weight with its own falling rate (AdaGrad)."""
        for a in range(0, len(bit), batch):
            s, g, w = logits[:, a:a + batch], gate[a:a + batch], n[a:a + batch]
            error = (bit[a:a + batch] - _sigmoid(self.mixed(s, g))) * w
            self.mass += np.bincount(g, w, len(self.weight))
            for i in range(len(s)):
                step = np.bincount(g, error * s[i], len(self.weight))
                self.square[:, i] += step * step
                self.weight[:, i] += rate * step / np.sqrt(self.square[:, i] + 1e-9)

    @staticmethod
    def bucket(z: np.ndarray) -> np.ndarray:
        return np.clip(np.rint((z + 8) * 2), 0, 32).astype(np.int64)

    def tally(self, z: np.ndarray, where: np.ndarray, bit: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(2, maps, 33): mass and ones by map cell."""
        cell = where * 33 + self.bucket(z)
        return np.stack([np.bincount(cell, n, self.map.size), np.bincount(cell, n * bit, self.map.size)])

    def refine(self, tally: np.ndarray) -> None:
        n, ones = tally.reshape(2, *self.map.shape)
        prior = _sigmoid((np.arange(33) - 16) / 2)
        p = (ones + 8 * prior) / (n + 8)
        self.map, self.ready = np.log(p / (1 - p)), True

    def cost(self, z: np.ndarray, where: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """log10 probability of each bit."""
        if self.ready:
            z = 0.5 * z + 0.5 * self.map[where, self.bucket(z)]
        return -np.logaddexp(0, np.where(bit == 1, -z, z)) / _LN10


def _rank_bits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes (n, depth), bits (n, depth)) of the ranks 0..n-1 in a binary tree."""
    ids = np.arange(n, dtype=np.int32)[:, None]
    d = np.arange(_DEPTH, dtype=np.int32)
    return (1 << d) | (ids >> (_DEPTH - d)), ((ids >> (_DEPTH - 1 - d)) & 1).astype(np.int8)


class RankModel:
    """Escape and rank bits: scores of all (class, dictionary token) pairs."""

    def __init__(self, a: np.ndarray, b: np.ndarray, rare_a: np.ndarray, rare_b: np.ndarray):
        """a, b: (classes, dictionary) counts of the folds; rare_*: other tokens by class."""
        classes, n = a.shape
        self.mixer = Mixer(_DEPTH * 4, 2, _DEPTH)
        total = a + b
        known, other = total.sum(1), rare_a + rare_b
        p = (known + 0.5) / (known + other + 1)
        self.escape = np.log10(1 - p)
        self.score = np.zeros((classes, n))
        if not n:
            return
        node, bit = _rank_bits(n)
        depth = np.arange(_DEPTH)
        for step in range(3):  # learn, refine, score
            source = a if step < 2 else total
            world, _ = self._logits(source.sum(0), node, bit)
            own, seen = (np.stack(x) for x in zip(*(self._logits(source[c], node, bit) for c in range(classes))))
            cell = np.flatnonzero(b.ravel() > 0) if step < 2 else np.arange(classes * n)
            np.random.default_rng(7).shuffle(cell)  # the frequent ones come first otherwise
            tally = np.zeros((2, self.mixer.map.size))
            for at in range(0, len(cell), 1 << 13):
                c, i = np.divmod(cell[at:at + (1 << 13)], n)
                at_node, y = node[i], bit[i].ravel()
                logits = np.stack([own[c[:, None], at_node].ravel(), world[at_node].ravel()])
                where = np.broadcast_to(depth, at_node.shape).ravel()
                gate = where * 4 + seen[c[:, None], at_node].ravel()
                mass = np.repeat(b[c, i], _DEPTH).astype(float)
                if step == 0:
                    self.mixer.learn(logits, gate, y, mass)
                    continue
                z = self.mixer.mixed(logits, gate)
                if step == 1:
                    tally += self.mixer.tally(z, where, y, mass)
                else:
                    self.score[c, i] = self.mixer.cost(z, where, y).reshape(-1, _DEPTH).sum(1) + np.log10(p[c])
            if step == 1:
                self.mixer.refine(tally)

    @staticmethod
    def _logits(counts: np.ndarray, node: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << _DEPTH
        n0, n1 = np.zeros(size), np.zeros(size)
        for d in range(_DEPTH):
            seen = np.bincount(node[:, d], counts, size)
            ones = np.bincount(node[:, d], counts * bit[:, d], size)
            n0 += seen - ones
            n1 += ones
        return _table(n0, n1)


def _spelled(batches, columns: list[str]):
    """Chunks of (record batch slice, words, classes) of at most _CHUNK decisions."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        cls = batch.column("cls").to_numpy().astype(np.int64)
        for i, j in _word_chunks(words):
            yield [batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in columns], words[i:j], cls[i:j]


class SpellModel:
    """Byte decisions of the other tokens, learnt from (cls, word, a, b) rows."""

    def __init__(self, rare: DataFrame):
        sc = rare.sparkSession.sparkContext
        n = self._counts(rare)
        half = sc.broadcast(_table(n[0], n[1]))
        self.mixer = self._learn(rare, half)
        self.mixer = self._refine(rare, half, self.mixer)
        half.unpersist()
        self.table = _table(n[0] + n[2], n[1] + n[3])

    @staticmethod
    def _counts(rare: DataFrame) -> np.ndarray:
        """(4, SLOTS): zeros and ones seen in fold A, then in fold B; summed
        exactly and rounded to float32 once."""
        step = 1 << 16

        def task(batches):
            def pieces(counts):
                for i in range(0, 4 * SLOTS, step):
                    some = counts[i:i + step]
                    seen = np.flatnonzero(some)
                    if len(seen):
                        yield pa.RecordBatch.from_arrays([pa.array([i // step], pa.int32()), pa.array([seen.astype("<u2").tobytes()], pa.binary()), pa.array([some[seen].astype("<f8").tobytes()], pa.binary())], ["part", "slots", "counts"])

            counts, held = np.zeros(4 * SLOTS, np.uint32), 0
            for masses, words, cls in _spelled(batches, ["a", "b"]):
                slots, bit, _, _, owner = spell(words, cls)
                more = sum(float(w[owner].astype(float).sum()) for w in masses)
                if held and held + more >= 1 << 32:
                    yield from pieces(counts)
                    counts[:], held = 0, 0
                wide = more >= 1 << 32  # beyond 32 bits at once: whole numbers, exact below 2**53
                into = np.zeros(4 * SLOTS) if wide else counts
                for k, w in enumerate(masses):
                    mass = w[owner].astype(into.dtype)
                    for row in slots:
                        np.add.at(into, (2 * k + bit) * SLOTS + row, mass)
                if wide:
                    yield from pieces(into)
                    del into
                else:
                    held += more
            yield from pieces(counts)

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, slots, n in zip(*(batch.column(c).to_pylist() for c in ("part", "slots", "counts"))):
                    sums.setdefault(part, np.zeros(step))[np.frombuffer(slots, "<u2")] += np.frombuffer(n, "<f8")
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

        out = np.zeros(-(-4 * SLOTS // step) * step, np.float32)
        few = rare.coalesce(max(1, rare.sparkSession.sparkContext.defaultParallelism))  # a count array each
        rows = few.mapInArrow(task, "part int, slots binary, counts binary").repartition("part").mapInArrow(add, "part int, counts binary")
        rows = stored(rows, "slot-counts")
        for r in rows.toLocalIterator():  # 16 * SLOTS bytes, a partition at a time
            out[r["part"] * step:(r["part"] + 1) * step] = np.frombuffer(r["counts"], np.float32)
        return out[:4 * SLOTS].reshape(4, SLOTS)

    @staticmethod
    def _inputs(table: tuple[np.ndarray, np.ndarray], words: list[bytes], cls: np.ndarray):
        slots, bit, gate, c0, owner = spell(words, cls)
        return table[0][slots], gate * 4 + table[1][slots[4]], bit, c0, owner

    def _learn(self, rare: DataFrame, half) -> Mixer:
        inputs = self._inputs

        def task(batches):
            mixer = Mixer(_GATES, 5, 256)
            for (b,), words, cls in _spelled(batches, ["b"]):
                logits, gate, bit, _, owner = inputs(half.value, words, cls)
                n = b[owner].astype(float)
                use = np.flatnonzero(n > 0)
                mixer.learn(logits[:, use], gate[use], bit[use], n[use])
            yield _pieces(np.concatenate(((mixer.weight * mixer.mass[:, None]).ravel(), mixer.mass)))

        got = _sum_parts(rare.where("b > 0").mapInArrow(task, "part int, values binary"), _GATES * 6)
        out = Mixer(_GATES, 5, 256)
        mass = got[_GATES * 5:]
        out.weight = np.where(mass[:, None] > 0, got[:_GATES * 5].reshape(_GATES, 5) / np.maximum(mass, 1e-9)[:, None], out.weight)
        return out

    def _refine(self, rare: DataFrame, half, mixer: Mixer) -> Mixer:
        inputs = self._inputs

        def task(batches):
            tally = np.zeros((2, mixer.map.size))
            for (b,), words, cls in _spelled(batches, ["b"]):
                logits, gate, bit, c0, owner = inputs(half.value, words, cls)
                tally += mixer.tally(mixer.mixed(logits, gate), c0, bit, b[owner].astype(float))
            yield _pieces(tally.ravel())

        mixer.refine(_sum_parts(rare.where("b > 0").mapInArrow(task, "part int, values binary"), 2 * mixer.map.size).reshape(2, -1))
        return mixer

    @staticmethod
    def scores(table, mixer: Mixer, words: list[bytes], cls: np.ndarray) -> np.ndarray:
        """log10 probability of spelling each word."""
        out = np.zeros(len(words))
        for i, j in _word_chunks(words):
            logits, gate, bit, c0, owner = SpellModel._inputs(table, words[i:j], cls[i:j])
            out[i:j] = np.bincount(owner, mixer.cost(mixer.mixed(logits, gate), c0, bit), j - i)
        return out


def score_documents(documents: DataFrame, held_out: Column | None = None, dictionary: int = DICTIONARY) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (the model's log10 probability), bits_per_byte (of the
    lower-cased text's words, each with one byte behind it)."""
    if not 0 < dictionary <= 1 << _DEPTH:
        raise ValueError(f"the dictionary holds 1 to {1 << _DEPTH} tokens")
    held_out = crc_remainder("doc_id", 5) == 1 if held_out is None else held_out
    docs = documents.select(id_column(documents), "text").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    fold = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 5), F.lit(2)).cast("int")
    train = docs.where(F.col("doc_id").isNotNull() & ~F.col("held_out")).withColumn("fold", fold)
    counts = stored(token_counts(train), "token-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(dictionary).toArrow()
    lexicon = Lexicon(top["word"].to_pylist(), top["n"].to_pylist())
    del top
    lexicon.clusters = _clusters(train, lexicon)
    by_class = stored(_class_counts(train, lexicon), "class-counts")
    dense = np.zeros((2, CLASSES + 1, max(len(lexicon.words), 1)), np.int64 if total > 1 << 31 else np.int32)
    t = by_class.where("idx >= 0").select("cls", "idx", "a", "b").toArrow()  # classes * dictionary rows at most
    dense[:, t["cls"].to_numpy(), t["idx"].to_numpy()] = [t["a"].to_numpy(), t["b"].to_numpy()]
    rare = by_class.where("idx < 0").select("cls", "word", "a", "b")
    others = np.zeros((2, CLASSES + 1))
    for r in rare.groupBy("cls").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect():
        others[:, r["cls"]] = r["a"], r["b"]
    del t
    size = len(lexicon.words)
    ranks = RankModel(dense[0][:, :size], dense[1][:, :size], *others)
    del dense
    speller = SpellModel(rare)
    return _scored(docs, counts, lexicon, ranks, speller, total, distinct)


def _scored(docs: DataFrame, counts: DataFrame, lexicon: Lexicon, ranks: RankModel, speller: SpellModel, total: int, distinct: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    floor = np.log10(total + 0.5 * (distinct + 1))
    base = np.log10(lexicon.counts + 0.5) - floor
    shared = sc.broadcast((lexicon, ranks.score.astype(np.float64), base))
    spelling = sc.broadcast((speller.table, speller.mixer, ranks.escape))
    sums = "doc_id long, body long, held_out boolean, n_tokens long, n_bytes long, n_known long, base double, score double"

    def frequent(batches):
        lexicon, score, base = shared.value
        index = lexicon.index()
        score, base = np.append(score.ravel(), 0.0), np.append(base, 0.0)
        d = len(lexicon.words)
        for batch in batches:
            for part, texts in _texts(batch):
                words, ids, opens, n = _flat(texts, index)
                cls = lexicon.classes(ids, opens)
                first = np.cumsum(n) - n
                per = lambda x: np.add.reduceat(x, first) if len(first) else x
                at = np.flatnonzero(ids < 0)
                doc = np.searchsorted(first, at, "right") - 1
                rare = [Counter() for _ in range(len(n))]
                for i, c, j in zip(doc.tolist(), cls[at].tolist(), at.tolist()):
                    rare[i][(c, words[j])] += 1
                size = per(np.array([len(w) + 1 for w in words], np.int64))
                own = [[{"cls": c, "word": w, "k": k} for (c, w), k in r.items()] for r in rare]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("body"), part.column("held_out"), pa.array(n), pa.array(size), pa.array(per((ids >= 0).astype(np.int64))),
                    pa.array(per(np.where(ids >= 0, base[ids], 0.0))), pa.array(per(np.where(ids >= 0, score[np.where(ids >= 0, cls * d + ids, -1)], 0.0))),
                    pa.array(own, pa.list_(pa.struct([("cls", pa.int32()), ("word", pa.binary()), ("k", pa.int64())])))],
                    ["doc_id", "body", "held_out", "n_tokens", "n_bytes", "n_known", "base", "score", "rare"])

    def spelled(batches):
        table, mixer, escape = spelling.value
        for batch in batches:
            words, cls = batch.column("word").to_pylist(), batch.column("cls").to_numpy().astype(np.int64)
            keys = list(zip(words, cls.tolist()))
            kinds = {key: i for i, key in enumerate(dict.fromkeys(keys))}
            word, c = [w for w, _ in kinds], np.array([c for _, c in kinds], np.int64)
            own = SpellModel.scores(table, mixer, word, c) + escape[c]
            k = batch.column("k").to_numpy()
            n = batch.column("n").to_numpy()
            zero = pa.array(np.zeros(len(k), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), batch.column("held_out"), zero, zero, pa.array(np.where(n > 0, k, 0)), pa.array(k * (np.log10(n + 0.5) - floor)), pa.array(k * own[[kinds[x] for x in keys]])], [c.split()[0] for c in sums.split(", ")])

    wide = docs.withColumn("body", F.xxhash64("text")).mapInArrow(frequent, sums + ", rare array<struct<cls:int,word:binary,k:long>>")
    wide = stored(wide, "scores")
    head = wide.drop("rare").withColumn("rows", F.lit(1).cast("long"))
    rare = wide.select("doc_id", "body", "held_out", F.explode("rare").alias("r")).select("doc_id", "body", "held_out", "r.*")
    rare = rare.join(counts, "word", "left").select("doc_id", "body", "held_out", "cls", "word", "k", F.coalesce("n", F.lit(0)).alias("n"))
    rest = rare.mapInArrow(spelled, sums).withColumn("rows", F.lit(0).cast("long"))
    keys = ["doc_id", "body", "held_out"]
    names = ["n_tokens", "n_bytes", "n_known", "base", "score", "rows"]
    out = head.unionByName(rest).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names))
    # Equal rows of one document were summed together: share out and repeat.
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    share = lambda c: (F.col(c) / F.col("rows"))
    return out.select("doc_id", "held_out", *(share(c).cast("long").alias(c) for c in ("n_tokens", "n_known")), F.lit(int(total)).cast("long").alias("train_tokens"),
                      share("base").alias("base_score"), share("score").alias("score"), (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"))

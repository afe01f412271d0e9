"""Toxicity by weak supervision.

Voters. Every voter watches for one family of cues and fires on a text that
has enough of them: seed lexicons of insults, words and word beginnings that
the labelled training rows show almost only in toxic texts (in strength
bands), and patterns (address plus insult, shouting, runs of exclamation
marks). Counts of 1, 2 and more hits are separate voters, so that density
speaks as well.

Label model. The votes of all training documents (labelled or not) are counted
by vote pattern. A latent-class model p(y) * prod_j p(vote_j | vote_parent(j), y)
gives every voter an accuracy per class and, through a tree over the voters
(maximum conditional mutual information), its correlation with another voter.
EM fits it on the pattern counts: labelled patterns add their known class,
unlabelled ones their posterior. It starts from the share of voters that fire.

Classifier. A logistic regression on voter counts and hashed words learns the
posteriors of a bounded draw of training documents and scores every text.

Defined results: null and empty texts have no cues and are scored; without
labels the seeds and patterns vote alone; rows with a null doc_id are scored,
never learnt from; conflicting labels of one doc_id count as the larger one;
an empty table gives an empty result.

Scale: labels are learnt from at most `labelled_rows` rows, half of each class,
those with the smallest id hashes; the votes of all training documents are
counted as map-side sums. The pattern table has at most 2**VOTERS rows, the cue
table `lexicon_size` rows, the classifier's draw 1.5 * `sample_rows` documents;
these alone reach the driver. No text is shuffled.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, crc_remainder, id_column, stored

SAMPLE_ROWS = 12_000
LABELLED_ROWS = 40_000
LEXICON_SIZE = 4_000
HASHED = 1 << 14
RESULT = "doc_id long, held_out boolean, score double, predicted int"

# Seed lexicons, one family a line.
SEEDS = {
    "stupid": "idiot moron stupid dumb imbecile fool clown idiota estupido idiot bete dumm dummkopf",
    "worthless": "loser worthless pathetic useless failure versager inutile inutil",
    "disgust": "scum trash disgusting filth vermin garbage abschaum ordure basura",
}
ADDRESS = frozenset("you your you're youre u ur du tu vous sie ihr usted".split())
_PREFIXES = (4, 5, 6)
_STRIP = b".,;:!?\"'()[]{}*_-"
#: Bands of mined cues, by strength; then the voters in order.
_BANDS = 3
_FAMILIES = [*SEEDS, *(f"word{i}" for i in range(_BANDS)), *(f"start{i}" for i in range(_BANDS))]
VOTERS = len(_FAMILIES) + 5


def _bare(text: str | None) -> list[bytes]:
    return [w for w in (x.strip(_STRIP) for x in (text or "").encode().lower().split()) if w]


def _texts(batch: pa.RecordBatch):
    for part, _, _ in blocks(batch):
        yield part, part.column("text")


def _starts(word: bytes) -> list[bytes]:
    """Word beginnings of 4 to 6 characters, shorter than the word."""
    w = word.decode()
    return [w[:k].encode() for k in _PREFIXES if len(w) > k]


def mined_cues(labelled: DataFrame, size: int = LEXICON_SIZE) -> dict[bytes, int]:
    """Cue (b"w" + word or b"s" + beginning) -> strength band, from documents
    (text, y). A cue is seen in enough toxic texts and, smoothed, at least 20
    times as often in toxic as in other texts."""

    def task(batches):
        counts: Counter = Counter()
        totals = [0, 0]

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([k[1] for k in keys], pa.binary()), pa.array([k[0] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())], ["cue", "y", "n"])

        for batch in batches:
            for part, texts in _texts(batch):
                for text, y in zip(texts.to_pylist(), part.column("y").to_pylist()):
                    words = set(_bare(text))
                    counts.update((y, b"w" + w) for w in words)
                    counts.update((y, b"s" + s) for s in {s for w in words for s in _starts(w)})
                    totals[y] += 1
                if len(counts) > 1_000_000:  # bounded memory; the shuffle adds up
                    yield out()
                    counts.clear()
        for y in (0, 1):
            counts[(y, b"#")] = totals[y]
        yield out()

    summed = labelled.mapInArrow(task, "cue binary, y int, n long").groupBy("cue").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"))
    totals = labelled.groupBy().agg(F.sum("y").alias("t1"), F.count(F.lit(1)).alias("t")).first()
    t1, t0 = int(totals["t1"] or 0), int(totals["t"] or 0) - int(totals["t1"] or 0)
    if not t1 or not t0:
        return {}
    ratio = ((F.col("n1") + 0.5) / (t1 + 1)) / ((F.col("n0") + 0.5) / (t0 + 1))
    best = summed.where((F.col("n1") >= max(4, 0.004 * t1)) & (F.length("cue") > 1)).withColumn("ratio", ratio).where("ratio >= 20")
    rows = best.orderBy(F.desc("n1"), F.desc("ratio"), "cue").limit(size).collect()
    order = sorted(rows, key=lambda r: (-r["ratio"], bytes(r["cue"])))
    return {bytes(r["cue"]): min(_BANDS - 1, i * _BANDS // len(order)) for i, r in enumerate(order)}


class Reader:
    """Looks texts up in the seeds and mined cues; built once a task. What a
    token means is remembered for up to `memory` tokens."""

    def __init__(self, cues: dict[bytes, int], memory: int = 400_000):
        self.cues, self.seeds, self.memory = cues, seed_table(), memory
        self.known: dict[bytes, tuple] = {}

    def _look(self, token: bytes) -> tuple[tuple[int, ...], int, bool]:
        """(families it hits, its hash slot, whether it addresses someone); slot -1: no word."""
        w = token.strip(_STRIP)
        if not w:
            return (), -1, False
        hit = [self.seeds[w]] if w in self.seeds else []
        if (b := self.cues.get(b"w" + w)) is not None:
            hit.append(len(SEEDS) + b)
        starts = [self.cues[b"s" + s] for s in _starts(w) if b"s" + s in self.cues]
        if starts:
            hit.append(len(SEEDS) + _BANDS + min(starts))
        return tuple(hit), xxhash.xxh64_intdigest(w) % HASHED, w in ADDRESS_BYTES

    def tokens(self, text: str | None) -> list[tuple]:
        known = self.known
        if len(known) > self.memory:
            known.clear()
        out = []
        for token in (text or "").encode().lower().split():
            got = known.get(token)
            if got is None:
                got = known[token] = self._look(token)
            out.append(got)
        return out

    def votes(self, text: str | None, tokens: list[tuple]) -> tuple[np.ndarray, int]:
        """(hits of each family, voters that fire as a bit mask)."""
        hits = [0] * len(_FAMILIES)
        total = addressed = 0
        for i, (families, _, _) in enumerate(tokens):
            if families:
                total += 1
                addressed += i > 0 and tokens[i - 1][2]
                for f in families:
                    hits[f] += 1
        t = text or ""
        flags = [*(h >= 1 for h in hits), total >= 2, total >= 4, addressed >= 1, "!!" in t, len(t) > 20 and t.upper() == t and t.lower() != t]
        return np.array(hits, float), sum(1 << j for j, on in enumerate(flags) if on)

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(dense, hashed word slots, vote mask) of a text."""
        tokens = self.tokens(text)
        hits, mask = self.votes(text, tokens)
        bits = np.array([(mask >> j) & 1 for j in range(VOTERS)])
        dense = np.concatenate((bits, np.log1p(hits), [np.log1p(hits.sum()), np.log1p(100 * hits.sum() / max(len(tokens), 1))]))
        return dense, np.array(sorted({x[1] for x in tokens} - {-1}), np.int64), mask


ADDRESS_BYTES = frozenset(x.encode() for x in ADDRESS)


def seed_table() -> dict[bytes, int]:
    return {w.encode(): i for i, line in enumerate(SEEDS.values()) for w in line.split()}


class LabelModel:
    """Latent class with a tree over binary voters."""

    def __init__(self, voters: int = VOTERS):
        self.m = voters
        self.parent = np.full(voters, -1)
        self.prior = 0.5
        self.p = np.full((voters, 2, 2), 0.5)  # voter, class, vote of the parent (0 for roots)

    def _log_joint(self, votes: np.ndarray) -> np.ndarray:
        out = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j in range(self.m):
            up = votes[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(votes), int)
            on = self.p[j][:, up].T
            out += np.log(np.where(votes[:, j:j + 1] == 1, on, 1 - on))
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        z = self._log_joint(votes)
        return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -50, 50)))

    def _tree(self, votes: np.ndarray, weight: np.ndarray) -> None:
        """Maximum spanning tree of the voters' conditional mutual information."""
        gain = np.zeros((self.m, self.m))
        for c in (0, 1):
            w = weight[:, c]
            total = w.sum() + 1e-9
            one = [votes == v for v in (0, 1)]
            single = [(w[:, None] * o).sum(0) / total for o in one]
            for a in (0, 1):
                for b in (0, 1):
                    joint = (one[a] * w[:, None]).T @ one[b] / total
                    gain += total * joint * np.log((joint + 1e-12) / (np.outer(single[a], single[b]) + 1e-12))
        gain /= weight.sum() + 1e-9
        inside, self.parent = [0], np.full(self.m, -1)
        while len(inside) < self.m:
            rest = [j for j in range(self.m) if j not in inside]
            sub = gain[np.ix_(inside, rest)]
            i, j = np.unravel_index(sub.argmax(), sub.shape)
            if sub[i, j] > 1e-4:  # otherwise independent: a root of its own
                self.parent[rest[j]] = inside[i]
            inside.append(rest[j])

    def fit(self, votes: np.ndarray, unknown: np.ndarray, known: np.ndarray, rounds: int = 40) -> LabelModel:
        """votes: patterns (n, m); unknown: documents without a label per
        pattern; known: (n, 2) documents of each class per pattern."""
        post = np.clip(votes[:, :self.m].sum(1) / 4, 0.02, 0.98)
        if known[:, 1].sum() and known[:, 0].sum():
            k = known.sum(1)
            post = np.where(k > 0, (known[:, 1] + post) / (k + 1), post)
        for r in range(rounds):
            weight = known + unknown[:, None] * np.column_stack([1 - post, post])
            if r % 10 == 0:
                self._tree(votes, weight)
            total = weight.sum(0)
            self.prior = float(np.clip(total[1] / max(total.sum(), 1e-9), 1e-4, 1 - 1e-4))
            for j in range(self.m):
                up = votes[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(votes), int)
                for u in (0, 1):
                    at = up == u
                    on = (weight[at] * votes[at, j:j + 1]).sum(0)
                    base = (weight * votes[:, j:j + 1]).sum(0) / np.maximum(total, 1e-9)
                    self.p[j][:, u] = (on + 0.5 * np.clip(base, 1e-3, 1 - 1e-3)) / (weight[at].sum(0) + 0.5)
            self.p = np.clip(self.p, 1e-5, 1 - 1e-5)
            post = self.posterior(votes)
        return self


DENSE = VOTERS + len(_FAMILIES) + 2


class Linear:
    """Logistic regression on dense features and hashed words."""

    def __init__(self):
        self.dense, self.hashed, self.bias = np.zeros(DENSE), np.zeros(HASHED), 0.0

    def logit(self, dense: np.ndarray, slots: np.ndarray) -> float:
        return float(dense @ self.dense + (self.hashed[slots].sum() / np.sqrt(len(slots)) if len(slots) else 0) + self.bias)

    def fit(self, dense: np.ndarray, slots: list[np.ndarray], target: np.ndarray, steps: int = 150, rate: float = 0.05, ridge: tuple[float, float] = (1e-4, 3e-3)) -> Linear:
        size = np.array([len(s) for s in slots])
        row = np.repeat(np.arange(len(slots)), size)
        flat = np.concatenate(slots) if len(slots) else np.zeros(0, np.int64)
        value = 1 / np.sqrt(np.maximum(size, 1))[row]
        w = np.zeros(DENSE + HASHED + 1)
        first, second = np.zeros_like(w), np.zeros_like(w)
        shrink = np.concatenate((np.full(DENSE, ridge[0]), np.full(HASHED, ridge[1]), [0]))
        for t in range(1, steps + 1):
            z = dense @ w[:DENSE] + np.bincount(row, w[DENSE + flat] * value, len(slots)) + w[-1]
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / max(len(target), 1)
            grad = np.concatenate((dense.T @ g, np.bincount(flat, g[row] * value, HASHED), [g.sum()])) + shrink * w
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
            w -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)
        self.dense, self.hashed, self.bias = w[:DENSE], w[DENSE:-1], float(w[-1])
        return self


def _votes_of(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS)) & 1


def toxicity_model(documents: DataFrame, labels: DataFrame, held_out: Column, sample_rows: int = SAMPLE_ROWS, labelled_rows: int = LABELLED_ROWS, lexicon_size: int = LEXICON_SIZE) -> tuple[dict[bytes, int], LabelModel, Linear]:
    """(mined cues, label model, classifier), learnt where `held_out` is false."""
    train = documents.select(id_column(documents), "text").where(F.col("doc_id").isNotNull() & ~held_out)
    known = labels.select(id_column(labels), F.col("toxic").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & ~held_out & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    few = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    known = stored(few(known.where("y = 1"), labelled_rows // 2).unionByName(few(known.where("y = 0"), labelled_rows // 2)), "labelled")
    marked = train.join(F.broadcast(known), "doc_id", "left")  # labelled_rows ids at most
    cues = mined_cues(train.join(F.broadcast(known), "doc_id").select("text", "y"), lexicon_size)

    def vote(batches):
        counts: Counter = Counter()
        reader = Reader(cues)
        for batch in batches:
            for part, texts in _texts(batch):
                counts.update((reader.votes(t, reader.tokens(t))[1], -1 if y is None else y) for t, y in zip(texts.to_pylist(), part.column("y").to_pylist()))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())], ["mask", "y", "n"])

    patterns = marked.select("text", "y").mapInArrow(vote, "mask long, y int, n long").groupBy("mask").pivot("y", [-1, 0, 1]).agg(F.sum("n")).orderBy("mask").collect()
    masks = np.array([r["mask"] for r in patterns], np.int64)
    n = np.array([[r[c] or 0 for c in ("-1", "0", "1")] for r in patterns], float).reshape(-1, 3)
    model = LabelModel().fit(_votes_of(masks), n[:, 0], n[:, 1:]) if len(masks) else LabelModel()
    # The draw: labelled toxic documents and any training documents.
    ids = few(known.where("y = 1").select("doc_id"), sample_rows // 2).unionByName(few(train.select("doc_id").distinct(), sample_rows)).distinct()

    def draw(batches):
        reader = Reader(cues)
        for batch in batches:
            for part, texts in _texts(batch):
                got = [reader.features(t) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([d.tobytes() for d, _, _ in got], pa.binary()), pa.array([s.astype(np.int16).tobytes() for _, s, _ in got], pa.binary()), pa.array([m for _, _, m in got], pa.int64())], ["doc_id", "dense", "slots", "mask"])

    rows = train.join(F.broadcast(ids), "doc_id").mapInArrow(draw, "doc_id long, dense binary, slots binary, mask long").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["slots"])))
    linear = Linear()
    if rows:
        dense = np.array([np.frombuffer(r["dense"]) for r in rows])
        slots = [np.frombuffer(r["slots"], np.int16).astype(np.int64) for r in rows]
        linear.fit(dense, slots, model.posterior(_votes_of(np.array([r["mask"] for r in rows], np.int64))))
    return cues, model, linear


def toxicity_scores(documents: DataFrame, labels: DataFrame, held_out: Column | None = None, sample_rows: int = SAMPLE_ROWS, labelled_rows: int = LABELLED_ROWS, lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """Per document: doc_id, held_out, score (likelihood of label 1) and
    predicted. No label is learnt from rows where `held_out` (by doc_id) holds."""
    held_out = crc_remainder("doc_id", 5) == 0 if held_out is None else held_out
    cues, _, linear = toxicity_model(documents, labels, held_out, sample_rows, labelled_rows, lexicon_size)
    rows = documents.select(id_column(documents), "text").withColumn("held_out", F.coalesce(held_out, F.lit(False)))

    def task(batches):
        reader = Reader(cues)
        for batch in batches:
            for part, texts in _texts(batch):
                z = np.array([linear.logit(*reader.features(t)[:2]) for t in texts.to_pylist()])
                s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(task, RESULT)

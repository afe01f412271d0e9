"""Quality classifier by non-negative positive-unlabelled learning.

Positives are trusted rows of a labels table (label 1), the unlabelled set is
a draw of all training documents, whatever their label. With the class prior
p the model minimises the non-negative risk

    p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))        (logistic loss)

by full-batch Adam; where the bracket falls below zero the step climbs it
instead, which keeps the model from fitting the positives by memory. The prior
is the share of label 1 among the training labels, or, where those hold
positives only, the mean score of a plain positive-against-unlabelled fit
divided by its mean on the positives (Elkan and Noto).

The score is a generalised additive model: some 60 measures of a text's form
(character classes, repeated words, lines and phrases, word shapes), each cut
at quantiles of the unlabelled sample, one weight per cut.

Defined results: null and empty texts measure zero everywhere and are scored
like any other; without positives every score is 0.5; rows of one doc_id are
scored by their own text; rows with a null doc_id are scored and never used to
learn; conflicting labels of one doc_id count as the smaller one; an empty
table gives an empty result; `classified` keeps other columns.

Scale: one pass of map tasks scores all texts; no shuffle of text. Training
takes at most `sample_rows` positives and as many unlabelled documents, those
with the smallest id hashes, whose measures (not texts) go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import blocks, crc_remainder, gram_hashes, gram_rows, id_column, word_hashes, words

SAMPLE_ROWS = 20_000
CUTS = 12
STEPS = 400
RESULT = "doc_id long, held_out boolean, score double, predicted int"

_SYMBOLS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]


def _distinct(key: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys of each row, count of its most frequent key)."""
    both = (row.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20))
    u, c = np.unique(both, return_counts=True)
    r = (u >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, r, c)
    return np.bincount(r, minlength=n).astype(float), top


def measures(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of measures per text of a block."""
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    row = np.repeat(np.arange(n), np.diff(offs))
    byte = np.bincount(row * 256 + buf, minlength=n * 256).reshape(n, 256).astype(float) if n else np.zeros((0, 256))
    whole = np.maximum(size, 1)[:, None]
    classes = np.stack([byte[:, a:b].sum(1) for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0), (0xC0, 0x100), (0, 0x20))], 1) / whole
    symbols = byte[:, _SYMBOLS] / whole
    start, end, first = words(buf, offs)
    m = np.diff(first).astype(float)
    some = np.maximum(m, 1)
    wrow = np.repeat(np.arange(n), np.diff(first))
    h = word_hashes(buf, start, end)
    per = lambda flag, r=wrow: np.bincount(r, flag, n)
    length = (end - start).astype(float)
    mean = per(length) / some
    head, tail = (buf[start], buf[end - 1]) if len(start) else (np.zeros(0, np.uint8),) * 2
    upper = lambda b: (b >= 0x41) & (b <= 0x5A)
    letter = lambda b: upper(b & 0xDF) | (b >= 0x80)
    stop = np.isin(tail, [0x2E, 0x2C])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    kinds, top = _distinct(h, wrow, n)
    columns = [np.log1p(size), np.log1p(m), mean, np.sqrt(np.maximum(per(length ** 2) / some - mean ** 2, 0)), kinds / some, top / some, per(again) / some,
               per(upper(head)) / some, per(upper(head) & upper(tail) & (length > 1)) / some, per(stop) / some, per(~letter(tail) & ~stop) / some, per(~letter(head)) / some, per(length == 1) / some, per(length > 15) / some]
    for k in (2, 4):
        at, grow = gram_rows(first, k)
        got, most = _distinct(gram_hashes(h, k)[at], grow, n)
        have = np.maximum(np.bincount(grow, minlength=n), 1)
        columns += [got / have, most / have]
    feed = np.zeros(256, bool)
    feed[:] = True
    feed[0x0A] = False
    ls, le, lf = words(buf, offs, feed)
    lines = np.diff(lf)
    lrow = np.repeat(np.arange(n), lines)
    lk, lt = _distinct(word_hashes(buf, ls, le), lrow, n)
    columns += [np.log1p(lines), lk / np.maximum(lines, 1), lt / np.maximum(lines, 1), size / np.maximum(lines, 1)]
    return np.nan_to_num(np.column_stack([*columns, classes, symbols])).astype(np.float32)


def _parts(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, 1 << 16):
        yield from blocks(batch.slice(at, 1 << 16))


class AdditiveModel:
    """sum over measures of the weight of the cut a value falls into."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.base = np.concatenate(([0], np.cumsum([len(e) + 1 for e in edges]))).astype(np.int64)
        self.weight = np.zeros(self.base[-1] + 1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") + self.base[j] for j, e in enumerate(self.edges)], 1)

    def logit(self, cells: np.ndarray) -> np.ndarray:
        return self.weight[cells].sum(1) + self.weight[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = STEPS, rate: float = 0.05, ridge: float = 2e-4) -> AdditiveModel:
    """Minimise the non-negative risk; `prior` None: estimate it as above."""
    edges = [np.unique(np.quantile(unlabelled[:, j], np.linspace(0, 1, CUTS + 1)[1:-1])) for j in range(unlabelled.shape[1])]
    model = AdditiveModel(edges)
    p, u = model.cells(positive), model.cells(unlabelled)
    if prior is None:
        _descend(model, p, u, None, steps, rate, ridge)
        prior = float(np.clip(_sigmoid(model.logit(u)).mean() / max(_sigmoid(model.logit(p)).mean(), 1e-6), 0.01, 0.99))
        model.weight[:] = 0
    _descend(model, p, u, float(np.clip(prior, 0.01, 0.99)), steps, rate, ridge)
    return model


def _descend(model: AdditiveModel, p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, rate: float, ridge: float) -> None:
    size = len(model.weight)
    grad_of = lambda cells, g: np.append(np.bincount(cells.ravel(), np.repeat(g, cells.shape[1]), size - 1), g.sum())
    first, second = np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        zp, zu = model.logit(p), model.logit(u)
        sp, su = _sigmoid(zp), _sigmoid(zu)
        if prior is None:
            g = grad_of(p, (sp - 1) / len(p)) + grad_of(u, su / len(u))
        else:
            # loss(z, +) = log(1 + e^-z), loss(z, -) = log(1 + e^z)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            below = grad_of(u, su / len(u)) - grad_of(p, prior * sp / len(p))
            g = grad_of(p, prior * (sp - 1) / len(p)) + below if negative >= 0 else -below
        g += ridge * model.weight * (np.arange(size) < size - 1)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        model.weight -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)


def _first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The n ids with the smallest hashes (all, if fewer)."""
    return ids.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _sample(documents: DataFrame, labels: DataFrame, train: Column, n: int) -> tuple[np.ndarray, np.ndarray, float | None]:
    """(measures of positives, of unlabelled, class prior) of the training rows."""
    known = labels.select(id_column(labels), F.col("quality").cast("int").alias("y")).where(train & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y"))
    total, ones = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    prior = ones / total if total and ones < total else None
    docs = documents.select(id_column(documents), "text")
    chosen = _first_ids(known.where("y = 1").select("doc_id"), n).withColumn("role", F.lit(1)).unionByName(_first_ids(docs.where(train).select("doc_id"), n).withColumn("role", F.lit(0)))
    rows = docs.join(F.broadcast(chosen), "doc_id")  # 2 n ids at most

    def task(batches):
        for batch in batches:
            for part, buf, offs in _parts(batch):
                x = measures(buf, offs)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("role"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "role", "x"])

    got = sorted((r["role"], r["doc_id"], bytes(r["x"])) for r in rows.mapInArrow(task, "doc_id long, role int, x binary").collect())
    pick = lambda role: np.array([np.frombuffer(x, np.float32) for r, _, x in got if r == role])
    return pick(1), pick(0), prior


def quality_scores(documents: DataFrame, labels: DataFrame, held_out: Column | None = None, sample_rows: int = SAMPLE_ROWS, prior: float | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score (likelihood of label 1) and
    predicted. Nothing is learnt from rows where `held_out` (by doc_id) holds."""
    held_out = crc_remainder("doc_id", 3) == 1 if held_out is None else held_out
    scorer = _scorer(documents, labels, held_out, sample_rows, prior)
    rows = documents.select(id_column(documents), "text").withColumn("held_out", F.coalesce(held_out, F.lit(False)))

    def task(batches):
        for batch in batches:
            for part, buf, offs in _parts(batch):
                s = scorer(buf, offs)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(task, RESULT)


def _scorer(documents: DataFrame, labels: DataFrame, held_out: Column, sample_rows: int, prior: float | None):
    positive, unlabelled, estimated = _sample(documents, labels, ~held_out, sample_rows)
    model = fit(positive, unlabelled, estimated if prior is None else prior) if len(positive) and len(unlabelled) else None
    return lambda buf, offs: _sigmoid(model.logit(model.cells(measures(buf, offs)))) if model else np.full(len(offs) - 1, 0.5)


def classified(documents: DataFrame, labels: DataFrame, held_out: Column | None = None, sample_rows: int = SAMPLE_ROWS, least: float = 0.5) -> DataFrame:
    """The documents scoring at least `least`, columns unchanged."""
    held_out = crc_remainder("doc_id", 3) == 1 if held_out is None else held_out
    scorer = _scorer(documents, labels, held_out, sample_rows, None)

    def task(batches):
        for batch in batches:
            for part, buf, offs in _parts(batch):
                yield part.filter(pa.array(scorer(buf, offs) >= least))

    return documents.mapInArrow(task, documents.schema)

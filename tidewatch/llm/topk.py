"""Exact top-k search by inner product with Fagin's threshold algorithm.

Every vector component x becomes floor(scale * x), so scores are integers and
ties are exact. The candidates are cut into blocks by a hash of their id. In a
block each dimension has a list of the candidates sorted by that component;
for a query the list is read from the end where q_j * x_j is largest. After
depth t, no unread candidate can score more than

    bound(t) = sum over j of max(q_j * top_j(t), q_j * bottom_j(t))

where top_j(t), bottom_j(t) are the t-th largest and smallest components. The
search of a block deepens in rounds, from a short first depth to twice the depth
before: it reads the new entries of all lists, scores the candidates it meets for
the first time (random access), takes the k-th score of all candidates met, and
stops when the bound falls below it (strictly, since a tie may win by id) or the
lists end. With near-isotropic vectors of many dimensions the bound stays loose
and most queries read on until nearly every candidate of a block has been met.

Defined results: vectors that are null or hold null or non-finite components
take no part. Components beyond 2**53 / scale are outside the contract; a score
beyond a signed 64-bit integer raises OverflowError.
Shorter vectors count as padded with zeros. Of repeated ids, the
lexicographically smallest vector counts. A query never meets a candidate of
its own id. A query without candidates has no rows. Other columns are ignored.

Scale: queries are cut into groups and candidates into blocks, both of bounded
row counts; a (group, block) pair is one cell of bounded size, so no task sees
more than `block_rows` candidates and `group_rows` queries whatever the input.
Each cell returns at most k rows a query, reduced by a rank per query whose
partial limit runs before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
GROUP_ROWS = 2048
FIRST_DEPTH = 4
_EXACT = float(1 << 53)
PART = "query_id long, vec_id long, score long"


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _scores(q: np.ndarray, x: np.ndarray, big: bool) -> np.ndarray:
    """Exact integer products of one query; `big`: sums may pass 2**53.
    OverflowError where a score is beyond a long."""
    if not big:
        return (x @ q).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return (whole(x) @ whole(q)).astype(np.int64).reshape(len(x))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best of one query: score down, id up."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def search_block(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int) -> tuple[list[tuple[int, np.ndarray]], int]:
    """The k best candidates of each query in one block: ([(query index,
    candidate indices)], number of candidates scored)."""
    n = len(x)
    order = np.argsort(x, axis=0, kind="stable")  # per dimension, ascending
    values = np.take_along_axis(x, order, axis=0)
    lists = np.ascontiguousarray(order.T.astype(np.int32))  # a row a dimension
    big = np.abs(q).sum(1).max(initial=0) * np.abs(x).max(initial=0) >= _EXACT
    found: list[tuple[int, np.ndarray]] = []
    scored = 0
    for i in range(len(q)):
        use = np.flatnonzero(q[i])
        own, top = q[i, use], q[i, use] > 0
        unread = xid != qid[i]
        seen, score, whole = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        depth, to = 0, FIRST_DEPTH if len(use) else n
        while True:
            to = min(to, n)
            new = np.zeros(n, bool)
            if to == n or not len(use):  # the lists end: every candidate has been met
                new[:] = True
            else:
                new[lists[use[top], n - to:n - depth]] = True
                new[lists[use[~top], depth:to]] = True
            new &= unread
            at = np.flatnonzero(new)
            unread &= ~new
            if len(at):
                # Random access: row by row, or, where a round meets much of the
                # block, by one pass over the rows where they lie.
                if whole is None and (big or 8 * len(at) < n):
                    new_score = _scores(q[i], x[at], big)
                else:
                    whole = _scores(q[i], x, big) if whole is None else whole
                    new_score = whole[at]
                seen, score = np.concatenate((seen, at)), np.concatenate((score, new_score))
                scored += len(at)
            depth = to
            if depth == n or not unread.any():
                break
            # A candidate unread at this depth has, in dimension j, at most the value
            # reached from the top (q_j > 0) or at least that reached from the bottom.
            edge = np.where(top, values[n - depth, use], values[depth - 1, use])
            bound = float(own @ edge)
            if big:  # sums beyond 2**53 are rounded: the bound is widened by more than that
                bound += float(np.abs(own) @ np.abs(edge)) * 2.0 ** -40 + 1
            if len(score) >= k and bound < np.partition(score, len(score) - k)[len(score) - k]:
                break
            to = 2 * depth
        found.append((i, seen[_best(score, xid[seen], k)]))
    return found, scored


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v): the usable vectors as integers, one per id."""
    x = F.col(f"`{vector_col}`")
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(math.inf)))
    return df.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole.alias("v"))


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """For frames of vectors(): each query's k highest inner products as
    (query_id, rank, vec_id, score), ties to the smaller vec_id."""
    n_blocks = max(1, math.ceil(candidates.count() / block_rows))
    n_groups = max(1, math.ceil(queries.count() / group_rows))
    cell = lambda b, g: (b * F.lit(n_groups) + g).cast("int").alias("cell")
    c = candidates.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("g"))
    q = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("b"))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dims = max(map(len, [*left["v"], *right["v"]]))
        sides = []
        for side in (left, right):
            m, ids = _matrix(side["v"], dims), side["vec_id"].to_numpy()
            by = np.lexsort((*m.T[::-1], ids))
            _, at = np.unique(ids[by], return_index=True)
            sides += [ids[by][at], m[by][at]]
        qid, qm, xid, xm = sides
        found, _ = search_block(qid, qm, xid, xm, k)
        qi = np.repeat([i for i, _ in found], [len(a) for _, a in found]).astype(int)
        xi = np.concatenate([a for _, a in found]).astype(int) if found else np.zeros(0, int)
        big = np.abs(qm).sum(1).max(initial=0) * np.abs(xm).max(initial=0)
        score = np.einsum("ij,ij->i", qm[qi], xm[xi]).astype(np.int64) if big < _EXACT else [sum(int(a) * int(b) for a, b in zip(qm[i], xm[j])) for i, j in zip(qi, xi)]
        return pd.DataFrame({"query_id": qid[qi], "vec_id": xid[xi], "score": score})

    parts = q.select("vec_id", "v", cell(F.col("b"), F.col("g"))).groupBy("cell").cogroup(c.select("vec_id", "v", cell(F.col("b"), F.col("g"))).groupBy("cell")).applyInPandas(one, PART)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

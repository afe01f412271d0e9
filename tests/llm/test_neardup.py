import random

import numpy as np
import pyarrow as pa

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm import neardup
from tidewatch.llm.neardup import components, near_duplicates, one_per_class


def weights(spark, docs):
    """Exact weighted vectors: tf * ln(1 + N / max(df, N / 100))."""
    known = [(d, t) for d, t in docs if d is not None]
    vecs = []
    for _, t in known:
        w = (t or "").encode().lower().split()
        grams = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        vecs.append({g: grams.count(g) for g in set(grams)})
    df = {}
    for v in vecs:
        for g in v:
            df[g] = df.get(g, 0) + 1
    n = len(known)
    return [{g: c * np.log1p(n / max(df[g], n / 100)) for g, c in v.items()} for v in vecs], [d for d, _ in known], [tuple((t or "").encode().lower().split()) for _, t in known]


def brute(spark, docs, threshold=0.8):
    vecs, ids, words = weights(spark, docs)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i in range(len(vecs)):
        for j in range(i):
            a, b = vecs[i], vecs[j]
            both = set(a) | set(b)
            low, high = (sum(f(a.get(g, 0), b.get(g, 0)) for g in both) for f in (min, max))
            if words[i] == words[j] or ids[i] == ids[j] or (high and low >= threshold * high):
                x, y = find(ids[i]), find(ids[j])
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def corpus():
    r = random.Random(8)
    docs = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One  TWO"), (5, "one two three")]
    for i in range(10, 60):
        docs.append((i, prose(i, r.randint(5, 300), 3000)))
    base = prose(500, 200, 5000).split()
    for i in range(100, 140):  # a group of near copies, single words changed
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"z{r.random()}"
        docs.append((i, " ".join(w)))
    for i in range(200, 230):  # unrelated texts sharing one passage
        docs.append((i, " ".join(base[:40]) + " " + prose(i, 120, 5000)))
    docs += [(300 + i, docs[12][1].replace(" ", "\n").upper()) for i in range(5)] + [(10, docs[6][1]), (None, docs[12][1]), (400, prose(7, 15_000, 9000)), (401, prose(7, 15_000, 9000) + " tail")]
    return docs


def test_classes_match_brute_force(spark):
    docs = corpus()
    got = near_duplicates(clashing(frame(spark, docs)).repartition(5)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(spark, docs)


def test_one_document_of_each_class_stays(spark):
    docs = corpus()
    df = clashing(frame(spark, docs))
    out = one_per_class(df)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(brute(spark, docs).values())) and kept.count(None) == 1


def test_samples_agree_as_often_as_the_weights_overlap():
    r = np.random.default_rng(1)
    shingle = np.sort(r.integers(0, 1 << 44, 300).astype(np.uint64))
    w = r.gamma(2, 1, (2, 300))
    row = np.repeat([0, 1], 300)
    got = neardup.samples(np.tile(shingle, 2), row, w.ravel(), 2, 3000)
    want = np.minimum(*w).sum() / np.maximum(*w).sum()
    assert abs((got[0] == got[1]).mean() - want) < 0.03


def test_shingles_count_repeats():
    text = pa.array(["a b c d e a b c d e", "", "x y"])
    from tidewatch.llm.textkit import flat

    shingle, row, count = neardup._shingles(*flat(text))
    assert sorted(count[row == 0].tolist()) == [1, 1, 1, 1, 2] and (row == 1).sum() == 0 and (row == 2).sum() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)], "a long, b long")
    assert {r["node"]: r["label"] for r in components(edges).collect()} == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_empty(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_members_that_share_part_of_a_replaced_passage(spark):
    """The leader (0) is similar to neither 1 nor 2, which are similar to each
    other by ten of the 23 words in its place; none of the eight least hashed
    shingles that each adds to the leader is among the other's."""
    base = [f"6896w{i}" for i in range(300)]
    r = [f"6896r{i}" for i in range(23)]
    m = r[:10] + [f"6896m{i}" for i in range(10, 23)]
    docs = [(0, " ".join(base)), *((k, " ".join(base[:100] + x + base[123:])) for k, x in ((1, r), (2, m)))]
    want = brute(spark, docs)
    assert want == {0: 0, 1: 1, 2: 1}
    assert {x["doc_id"]: x["class_id"] for x in near_duplicates(frame(spark, docs)).collect()} == want


def test_rows_of_one_id_with_several_texts(spark):
    """3 and 5 share a text, 5 and 7 another: one class of documents, but both
    texts stay; so do both texts of 9, and 11 has copies of a null id's text."""
    x, y, z, v = (prose(i, 80, 5000) for i in (71, 72, 73, 74))
    docs = frame(spark, [(3, x), (5, x), (5, y), (7, y), (9, z), (9, v), (11, ""), (11, None), (None, x), (None, x)])
    got = near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in got) == [(3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (9, 9, True), (9, 9, True), (11, 11, True), (11, 11, True)]
    kept = [(r["doc_id"], r["text"] or "") for r in one_per_class(clashing(docs)).collect()]
    assert sorted(k for k in kept if k[0] is not None) == sorted([(3, x), (5, y), (9, z), (9, v), (11, "")])
    assert kept.count((None, x)) == 2


def _compared_pairs(spark, docs, monkeypatch):
    """(class of each document, how many pairs of texts were compared)."""
    found = []
    compared = neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda pairs, *rest: found.append(pairs.count()) or compared(pairs, *rest))
    return {r["doc_id"]: r["class_id"] for r in near_duplicates(frame(spark, docs)).collect()}, sum(found)


def test_texts_with_a_passage_in_common_are_not_compared_in_pairs(spark, monkeypatch):
    """The leader (0) lacks a part of the passage that all others share; they are
    similar to each other by 0.7."""
    shared = [f"p{i}" for i in range(300)]
    docs = [(0, " ".join(shared[:200])), *((i, " ".join(shared + [f"o{i}x{j}" for j in range(30)])) for i in range(1, 61))]
    docs += [(i, f"filler {i} a{i} b{i} c{i} d{i} e{i}") for i in range(100, 640)]
    got, compared = _compared_pairs(spark, docs, monkeypatch)
    assert got == {i: i for i, _ in docs}
    assert compared <= neardup.BANDS * 61


def test_near_copies_unlike_their_leader_are_compared_once_per_class(spark, monkeypatch):
    """60 near copies, by 0.9 similar to each other and by less than 0.7 to the leader."""
    shared = [f"p{i}" for i in range(300)]
    docs = [(0, " ".join(shared[:200])), *((i, " ".join(shared + [f"o{i}x{j}" for j in range(4)])) for i in range(1, 61))]
    docs += [(i, f"filler {i} a{i} b{i} c{i} d{i} e{i}") for i in range(100, 640)]
    got, compared = _compared_pairs(spark, docs, monkeypatch)
    assert got == {i: 1 if 0 < i < 100 else i for i, _ in docs}
    assert compared <= neardup.BANDS * 61

import random
import zlib

import numpy as np

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.toxicity import VOTERS, LabelModel, toxicity_scores

LABEL = "doc_id long, quality int, toxic int"


def setting(n=800):
    r = random.Random(4)
    toxic = {i for i in range(n) if r.random() < 0.2}
    docs = []
    for i in range(n):
        w = prose(i, r.randint(30, 80), 2000).split()
        if i in toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "moron!", f"grobe{r.randrange(40)}", f"VILEX{r.randrange(40)},", "nastiest"]))
        docs.append((i, " ".join(w)))
    docs += [(n, None), (n + 1, ""), (None, "idiot moron"), (7, docs[7][1]), (n + 2, "calm words " * 20_000)]
    labels = [(i, 1, int(i in toxic)) for i in range(n) if r.random() < 0.6]
    return docs, toxic, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def scores(spark, docs, labels, **options):
    out = toxicity_scores(clashing(frame(spark, docs)), spark.createDataFrame(labels, LABEL), **options).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    return {r["doc_id"]: r for r in out}


def test_held_out_documents_are_told_apart(spark):
    docs, toxic, labels = setting()
    got = scores(spark, docs, labels)
    rest = [i for i in range(800) if held(i)]
    assert np.mean([got[i]["predicted"] == (i in toxic) for i in rest]) > 0.95
    assert got[800]["predicted"] == got[801]["predicted"] == got[802]["predicted"] == 0


def test_held_out_labels_teach_nothing(spark):
    docs, _, labels = setting(300)
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels] + [(None, 1, 1), (3, 1, None)]
    a, b = scores(spark, docs, labels), scores(spark, docs, flipped)
    assert {i: r["score"] for i, r in a.items()} == {i: r["score"] for i, r in b.items()}


def test_seeds_vote_without_labels(spark):
    docs = [(i, prose(i, 40) + (" you idiot, stupid loser" if i % 4 == 0 else "")) for i in range(300)]
    got = scores(spark, docs, [])
    hit = np.mean([got[i]["score"] for i in range(0, 300, 4)])
    assert hit > np.mean([got[i]["score"] for i in range(300) if i % 4]) + 0.2


def test_label_model_finds_accuracies_and_a_correlated_pair():
    r = np.random.default_rng(5)
    y = r.random(20_000) < 0.3
    votes = np.zeros((20_000, VOTERS), int)
    for j in range(6):
        votes[:, j] = np.where(y, r.random(20_000) < 0.7, r.random(20_000) < 0.1)
    votes[:, 6] = np.where(r.random(20_000) < 0.95, votes[:, 5], 1 - votes[:, 5])  # a copy of voter 5
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = LabelModel().fit(patterns, n.astype(float), np.zeros((len(patterns), 2)))
    assert model.parent[6] == 5 or model.parent[5] == 6
    assert ((model.posterior(patterns)[at.ravel()] > 0.5) == y).mean() > 0.93
    assert abs(model.prior - 0.3) < 0.05


def test_empty(spark):
    assert toxicity_scores(frame(spark, []), spark.createDataFrame([], LABEL)).count() == 0

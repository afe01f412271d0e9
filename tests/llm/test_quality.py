import random
import zlib

import numpy as np

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.quality import classified, fit, quality_scores

LABEL = "doc_id long, quality int, toxic int"


def junk(i):
    r = random.Random(i)
    w = prose(i, 40).split()
    return r.choice([lambda: " ".join(x + r.choice(["***", "$$$", "%%%"]) for x in w), lambda: " ".join(w).upper() + "!!", lambda: " ".join([w[0]] * 50), lambda: " | ".join(w)])()


def setting(spark, n=600):
    r = random.Random(1)
    bad = {i for i in range(n) if r.random() < 0.25}
    docs = [(i, junk(i) if i in bad else ". ".join(prose(i * 7 + k, 9).capitalize() for k in range(5)) + ".") for i in range(n)]
    docs += [(n, None), (n + 1, ""), (None, "no id"), (5, docs[5][1]), (n + 2, "long " * 30_000)]
    labels = [(i, int(i not in bad), 0) for i in range(n) if r.random() < 0.6]
    return docs, bad, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def scores(spark, docs, labels, **options):
    out = quality_scores(clashing(frame(spark, docs)), spark.createDataFrame(labels, LABEL), **options).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    return {r["doc_id"]: r for r in out}


def test_held_out_documents_are_told_apart(spark):
    docs, bad, labels = setting(spark)
    got = scores(spark, docs, labels)
    rest = [i for i in range(600) if held(i)]
    assert all(got[i]["held_out"] == held(i) for i in range(600)) and got[None]["held_out"] is False
    assert np.mean([got[i]["predicted"] == (i not in bad) for i in rest]) > 0.93


def test_held_out_labels_teach_nothing(spark):
    docs, _, labels = setting(spark, 200)
    flipped = [(i, 1 - q if held(i) else q, t) for i, q, t in labels] + [(None, 0, 0), (3, None, 0)]
    a, b = scores(spark, docs, labels), scores(spark, docs, flipped)
    assert {i: r["score"] for i, r in a.items()} == {i: r["score"] for i, r in b.items()}


def test_positives_alone_and_none_at_all(spark):
    docs, bad, labels = setting(spark)
    got = scores(spark, docs, [x for x in labels if x[1] == 1])
    rank = sorted(range(600), key=lambda i: got[i]["score"])
    assert np.mean([i in bad for i in rank[:len(bad) // 2]]) > 0.9
    assert {r["score"] for r in scores(spark, docs, [(1, 0, 0)]).values()} == {0.5}


def test_small_draws_and_empty_tables(spark):
    docs, _, labels = setting(spark, 120)
    scores(spark, docs, labels, sample_rows=20)
    empty = frame(spark, [])
    assert quality_scores(empty, spark.createDataFrame([], LABEL)).count() == 0


def test_clean_documents_stay_with_all_columns(spark):
    docs, bad, labels = setting(spark)
    df = clashing(frame(spark, docs))
    out = classified(df, spark.createDataFrame(labels, LABEL))
    assert out.columns == df.columns
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert np.mean([i in kept for i in range(600) if i not in bad]) > 0.95 and np.mean([i in kept for i in bad]) < 0.2


def test_risk_bracket_keeps_memorised_positives_out():
    r = np.random.default_rng(0)
    y = r.random(3000) < 0.7
    x = (r.normal(size=(3000, 3)) + y[:, None] * [1.5, 0, 0]).astype(np.float32)
    model = fit(x[y][:600], x, 0.7)
    assert ((model.logit(model.cells(x)) > 0) == y).mean() > 0.75

import random

import numpy as np

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.domain_mix import fitted_rates, mix_rates, mixed, posteriors

LABEL = "doc_id long, quality int, toxic int"


def setting(n=300):
    r = random.Random(3)
    kind = {i: r.choice(["q1t0", "q1t0", "q0t0", "q1t1"]) for i in range(n)}
    say = {"q1t0": lambda i: prose(i, 40), "q0t0": lambda i: prose(i, 40).replace(" ", "*** ") + "***", "q1t1": lambda i: prose(i, 40) + " idiot moron scum" * 3}
    docs = [(i, say[kind[i]](i)) for i in range(n)]
    labels = [(i, int(kind[i][1]), int(kind[i][3])) for i in range(n) if r.random() < 0.5]
    return docs + [(n, None), (n + 1, ""), (None, "w1 w2"), (4, docs[4][1]), (n + 2, prose(1, 25_000))], labels, kind


def test_expected_tokens_meet_the_targets(spark):
    docs, labels, kind = setting()
    df, lab = frame(spark, docs), spark.createDataFrame(labels, LABEL)
    targets = {"q1t0": 0.7, "q0t0": 0.2, "q1t1": 0.1}
    names, members = posteriors(df, lab)
    rows = fitted_rates(members, names, targets).collect()
    mass = np.array([r["rows"] * r["n"] for r in rows])
    p, rate = np.array([r["p"] for r in rows]), np.array([r["rate"] for r in rows])
    assert (rate >= 0).all() and np.allclose(p.sum(1), 1)
    assert np.allclose((mass * rate) @ p / mass.sum(), [targets[d] for d in names], atol=1e-5)
    got = {r["doc_id"]: r for r in mix_rates(clashing(df), lab, targets).collect()}
    assert np.mean([got[i]["domain"] == kind[i] for i in kind]) > 0.9
    assert [got[i]["n_tokens"] for i in (300, 301, 302)] == [0, 0, 25_000]


def test_same_iterates_as_plain_projected_gradient(spark):
    docs, labels, _ = setting(120)
    names, members = posteriors(frame(spark, docs), spark.createDataFrame(labels, LABEL))
    rows = fitted_rates(members, names, {"q0t0": 1.0}, tolerance=0, rounds=9).collect()  # all weight on one domain: rates meet zero
    mass = np.array([r["rows"] * r["n"] for r in rows])
    p, x = np.array([r["p"] for r in rows]), np.ones(len(rows))
    own, want = mass @ p, np.array([float(d == "q0t0") for d in names]) * mass.sum()
    for _ in range(9):
        x = np.maximum(0, x - p @ (((mass * x) @ p - want) / own))
    assert np.allclose(x, [r["rate"] for r in rows], atol=1e-9) and (x == 0).any()


def test_columns_and_rows_stay(spark):
    docs, labels, _ = setting(60)
    df = clashing(frame(spark, docs)).withColumnRenamed("kept", "mix_rate")
    out = mixed(df, spark.createDataFrame(labels, LABEL))
    assert out.count() == len(docs) and set(df.columns) < set(out.columns) and len(out.columns) == len(set(out.columns))
    four = [r["mix_rate"] for r in out.collect() if r["doc_id"] == 4]
    assert len(four) == 2 and four[0] == four[1]


def test_no_labels_and_no_rows(spark):
    docs, labels, _ = setting(30)
    none = spark.createDataFrame([(1, None, 1), (None, 1, 1)], LABEL)
    rows = mix_rates(frame(spark, docs), none).collect()
    assert {r["rate"] for r in rows} == {1.0} and {r["domain"] for r in rows} == {None} and len(rows) == len(docs)
    assert mix_rates(frame(spark, []), spark.createDataFrame(labels, LABEL)).count() == 0


def test_main_path_has_no_python(spark):
    docs, labels, _ = setting(30)
    plan = mix_rates(frame(spark, docs), spark.createDataFrame(labels, LABEL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

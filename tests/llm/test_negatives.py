import math
import random

import numpy as np
import pytest

from tidewatch.llm.negatives import hard_negatives, labelled_vectors, lane_scores, pack_fields

SCHEMA = "vec_id long, embedding array<float>, label int, key int, id int, score int, rank int, bucket int, ids int"


def brute(rows, anchors, k=5, low=80):
    v = {}
    for i, e, label in sorted((r for r in rows if None not in r[:3:2] and r[1] is not None), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in e):
            v.setdefault(i, ([math.floor(256 * float(np.float32(x))) for x in e], label))
    out = []
    for a in sorted(i for i in v if i in anchors):
        score = {i: sum(x * y for x, y in zip(v[a][0], v[i][0])) for i in v if i != a}
        first = lambda some: sorted(some, key=lambda i: (-score[i], i))[:k]
        for p in first(i for i in score if v[i][1] == v[a][1]):
            hard = first(i for i in score if v[i][1] != v[a][1] and low * score[p] <= 100 * score[i] <= 100 * score[p])
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(hard)]
    return sorted(out)


def rows(n, dims=6, labels=3, seed=1):
    r = random.Random(seed)
    return [(i, [r.choice((0.0, 0.5, r.gauss(0.2, 0.4))) for _ in range(dims)], r.randrange(labels)) for i in range(n)]


def mine(spark, data, every=10, **options):
    df = labelled_vectors(spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in data], SCHEMA))
    return sorted(map(tuple, hard_negatives(df, df.where(f"vec_id % {every} = 0"), **options).collect()))


def anchors(data, every=10):
    return {r[0] for r in data if r[0] is not None and r[0] % every == 0}


@pytest.mark.parametrize("options", [{}, {"lanes": 7, "bucket_rows": 40, "group_rows": 5}, {"n_positives": 2, "n_negatives": 3}])
def test_matches_brute_force_with_ties(spark, options):
    data = rows(250) + [(1000 + i, [0.5] * 6, i % 3) for i in range(30)]
    want = brute(data, anchors(data))
    if "n_positives" in options:
        best = {(a, p) for a in anchors(data) for p in [x[1] for x in want if x[0] == a]}
        got = mine(spark, data, **options)
        assert {x[:2] for x in got} <= best and all(x in want for x in got) and max(x[2] for x in got) == 3
    else:
        assert mine(spark, data, **options) == want


def test_rows_without_label_vector_or_id_take_no_part(spark):
    data = rows(60) + [(100, None, 1), (110, [float("nan")] + [0.0] * 5, 1), (120, [0.5] * 6, None), (None, [0.5] * 6, 1), (130, [None] * 6, 0), (140, [float("inf")] * 6, 0)]
    assert mine(spark, data) == brute(data, anchors(data))


def test_one_label_few_rows_repeats_and_empty(spark):
    assert mine(spark, [(i, [1.0], 1) for i in range(20)]) == []
    assert mine(spark, []) == []
    assert mine(spark, rows(1)) == []
    assert mine(spark, rows(40) * 2) == brute(rows(40), anchors(rows(40)))
    wide = [(i, [0.5] * (1 + i % 4), i % 2) for i in range(40)]  # shorter vectors end in zeros
    assert mine(spark, wide) == brute(wide, anchors(wide))


def test_negative_positives_have_no_band(spark):
    data = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.9], 1), (3, [-1.0], 1)]
    assert mine(spark, data) == []


@pytest.mark.parametrize("size", [40.0, 2.0 ** 14, 2.0 ** 22])
def test_large_components_take_wider_fields(spark, size):
    data = [(i, [x * size for x in e], label) for i, e, label in rows(60, 3)]
    assert mine(spark, data) == brute(data, anchors(data))


def test_scores_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        mine(spark, [(i, [2.0 ** 40, 1.0], i % 2) for i in range(12)])


def test_fields_do_not_touch_each_other():
    r = np.random.default_rng(4)
    for width, top in ((4, 300), (8, 1 << 27), (11, 1 << 36)):
        x, a = r.integers(-top, top, (50, 5)), r.integers(-top, top, 5)
        bias = int(-x.min())
        wide = [int.from_bytes(w, "little") for w in pack_fields(list(x.T), bias, width)]
        want = [sum(int(p) * int(q) for p, q in zip(row, a)) for row in x]
        if max(map(abs, want)) < 1 << 63:
            assert lane_scores([int(q) for q in a], wide, 50, width, bias).tolist() == want

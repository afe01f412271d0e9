import math
import random

import numpy as np
import pytest

from tidewatch.llm.topk import exact_top_k, search_block, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    v = {i: [math.floor(64 * float(np.float32(x))) for x in e] for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in sorted(i for i in v if i in queries):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in v if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def rows(n, dims=8, seed=1):
    r = random.Random(seed)
    return [(i, [r.choice((0.0, 0.25, r.gauss(0, 0.3))) for _ in range(dims)]) for i in range(n)]


def search(spark, data, every, k=20, **options):
    all_rows = vectors(spark.createDataFrame([(i, e, 0) for i, e in data], SCHEMA))
    got = exact_top_k(all_rows, all_rows.where(f"vec_id % {every} = 0"), k, **options)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("options", [{}, {"block_rows": 37, "group_rows": 5}])
def test_matches_brute_force_with_ties(spark, options):
    data = rows(300) + [(1000 + i, [0.25] * 8) for i in range(30)]  # thirty equal vectors
    assert search(spark, data, 20, **options) == brute(data, {i for i, _ in data if i % 20 == 0}, 20)


def test_nulls_and_odd_values_take_no_part(spark):
    data = rows(30) + [(100, None), (120, [None] * 8), (140, [float("nan")] + [0.0] * 7), (160, [float("inf")] + [0.0] * 7), (180, [0.0] * 8)]
    assert search(spark, data, 20, 3) == brute(data, {0, 20, 180}, 3)


def test_few_rows_repeats_and_empty(spark):
    assert search(spark, rows(3), 20) == brute(rows(3), {0}, 20)
    assert search(spark, rows(1), 20) == []
    assert search(spark, [], 20) == []
    assert search(spark, rows(40) * 2, 20) == brute(rows(40), {0, 20}, 20)


def test_large_components_stay_exact(spark):
    data = [(i, [float(2 ** 23 + i), float(-(2 ** 23))]) for i in range(25)]  # scores near 2**59
    assert search(spark, data, 20, 5) == brute(data, {0, 20}, 5)
    r = random.Random(9)
    data = [(i, [float(np.float32(r.gauss(0, 2 ** 20))) for _ in range(4)]) for i in range(400)]
    assert search(spark, data, 20, 5) == brute(data, {i for i, _ in data if i % 20 == 0}, 5)


def test_scores_beyond_a_long_are_an_error(spark):
    data = [(i, [float(2 ** 27 + i), float(-(2 ** 27))]) for i in range(25)]  # scores near 2**67
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        search(spark, data, 20, 5)


def test_threshold_stops_early_where_lists_are_skewed():
    r = np.random.default_rng(3)
    x = np.floor(r.pareto(1.2, (4000, 4)) * 8)
    q = x[:5]
    found, scored = search_block(np.arange(5), q, np.arange(4000), x, 10)
    for i, at in found:
        s = x @ q[i]
        want = sorted((-s[j], j) for j in range(4000) if j != i)[:10]
        assert [(-s[j], j) for j in at] == want
    assert scored < 0.5 * 5 * 4000

import hashlib
import random

import pytest

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.substrings import repeat_digest, without_repeats


def brute(docs, width=13):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[i:i + width])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i:i + width])] < d:
                gone |= set(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=5, n=60):
    r = random.Random(seed)
    passages = [prose(100 + i, k) for i, k in enumerate((13, 14, 40, 200))]
    hot = prose(999, 9)  # shorter than a window: one anchor, ever new surroundings
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, prose(3, 12))]
    for i in range(4, n):
        t = [prose(r.random(), r.randint(1, 60), 5000) for _ in range(r.randint(1, 3))]
        t += r.sample(passages, r.randint(0, 2)) + [hot] * r.randint(0, 2)
        r.shuffle(t)
        docs.append((i, r.choice([" ", "\n", "\t  "]).join(t)))
    docs += [(n, "a b " * 300), (n + 1, "b a " * 300), (n + 2, docs[8][1]), (n + 3, docs[8][1].replace(" ", "\r\n")), (9, docs[9][1]), (None, docs[8][1]), (n + 4, prose(77, 30_000)), (n + 5, prose(77, 30_000)[100:])]
    return docs


@pytest.mark.parametrize("options", [{}, {"filter_bits": 6, "shard_rows": 5}])
def test_matches_brute_force(spark, options):
    docs = corpus()
    got = repeat_digest(clashing(frame(spark, docs)).repartition(4), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_texts_are_cut_and_columns_stay(spark):
    docs = corpus(n=20)
    df = clashing(frame(spark, docs))
    out = without_repeats(df)
    assert out.columns == df.columns
    want = {(d, n - gone) for d, n, gone, _ in brute(docs)}
    assert {(r["doc_id"], len((r["text"] or "").split())) for r in out.collect()} == want


def test_empty(spark):
    assert repeat_digest(frame(spark, [])).count() == 0

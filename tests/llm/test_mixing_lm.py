import collections
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm import mixing_lm as lm


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def tokens(t):
    return (t or "").encode().lower().split() + [b""]


def base(docs):
    c = collections.Counter()
    for i, t in docs:
        if i is not None and not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return n, [(i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for i, t in docs]


def setting():
    two = [lambda s: prose(s, 60, 300), lambda s: prose(s, 60, 300).replace("w", "ö")]
    docs = [(i, two[i % 2](i)) for i in range(400)]
    return docs + [(400, None), (401, ""), (402, " \n\x0b"), (403, "Ünseen WORDS x" + "y" * 500), (None, "w1 w2"), (5, docs[5][1]), (5, docs[5][1]), (404, prose(9, 20_000, 900))]


def check(rows, docs):
    want = sorted(base(docs)[1], key=repr)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def test_base_matches_brute_force_and_the_model_beats_it(spark):
    docs = setting()
    rows = lm.score_documents(clashing(frame(spark, docs)).repartition(4)).collect()
    check(rows, docs)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in rows)
    rest = [r for r in rows if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in rest) > sum(r["base_score"] for r in rest)
    five = [r["score"] for r in rows if r["doc_id"] == 5]
    assert len(five) == 3 and len(set(five)) == 1


def test_a_small_dictionary_gives_the_same_counts(spark):
    docs = setting()[:120]
    check(lm.score_documents(frame(spark, docs), dictionary=16).collect(), docs)


def test_held_out_texts_teach_nothing(spark):
    docs = [(i, prose(i, 40)) for i in range(60)]
    other = [(i, "entirely different words" if held(i) else t) for i, t in docs]
    a, b = ({r["doc_id"]: r["score"] for r in lm.score_documents(frame(spark, x)).collect()} for x in (docs, other))
    assert all(math.isclose(a[i], b[i]) for i in a if not held(i))


def test_no_training_rows_and_no_rows(spark):
    only = [(i, "a b") for i in range(200) if held(i)][:3]
    rows = lm.score_documents(frame(spark, only)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(0, 0, 0.0)] * 3
    assert lm.score_documents(frame(spark, [])).count() == 0


def test_bits_of_a_byte_are_a_distribution():
    r = np.random.default_rng(2)
    table = lm._table(r.integers(0, 9, lm.SLOTS).astype(np.float32), r.integers(0, 9, lm.SLOTS).astype(np.float32))
    mixer = lm.Mixer(lm._GATES, 5, 256)
    mixer.refine(r.random((2, mixer.map.size)) * 5 + [[9], [0]])
    words = [b"ab" + bytes([c]) for c in range(256)]
    logits, gate, bit, c0, owner = lm.SpellModel._inputs(table, words, np.full(256, 3))
    cost = mixer.cost(mixer.mixed(logits, gate), c0, bit).reshape(256, 4, 8)
    assert math.isclose((10 ** cost[:, 2].sum(1)).sum(), 1, rel_tol=1e-6)


def test_rank_codes_and_escape_are_a_distribution():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 50, (2, 9, 700))
    rare = r.integers(0, 90, (2, 9))
    model = lm.RankModel(a, b, *rare)
    total = (10 ** model.score).sum(1) + 10 ** model.escape
    assert (total <= 1 + 1e-9).all() and (total > 0.9).all()


def test_slot_counts_grow_past_the_float32_integers(spark):
    rows = [(0, b"zq", 1 << 24, 0)] + [(0, b"z" + bytes([97 + i]), 1, 0) for i in range(20)]
    rare = spark.createDataFrame([(c, bytearray(w), a, b) for c, w, a, b in rows], "cls int, word binary, a long, b long").coalesce(1).sortWithinPartitions("a", ascending=False)
    counts = lm.SpellModel._counts(rare)
    assert counts[0, 1] + counts[1, 1] == (1 << 24) + 20  # the first bit of the first byte


def _peak_mb(count, *rest):
    """Memory of the task that `count` runs on 6 MB of different words, and its longest batch."""

    class Caught:
        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            self.task = task
            raise StopIteration

    caught = Caught()
    with pytest.raises(StopIteration):
        count(caught, *rest)
    texts = [" ".join(f"w{i:05d}{j:05d}" for j in range(500)) for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "fold": [i % 2 for i in range(1000)]})
    tracemalloc.start()
    longest = words = 0
    for out in caught.task(iter([batch])):
        longest, words = max(longest, out.num_rows), words + out.num_rows
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert words >= 500_000
    return peak, longest


def test_counting_tasks_hold_little():
    for count, rest in ((lm.token_counts, ()), (lm._class_counts, (lm.Lexicon([b"a", b"b"], [5, 4]),))):
        peak, longest = _peak_mb(count, *rest)
        assert peak < 60 and longest <= 1 << 15, (count.__name__, peak, longest)


def test_slot_counts_hold_four_bytes_a_slot_and_stay_exact():
    class Rare:
        sparkSession = type("Session", (), {"sparkContext": type("Context", (), {"defaultParallelism": 1})})

        def coalesce(self, n):
            return self

        def mapInArrow(self, task, schema):
            self.task = task
            raise StopIteration

    rare = Rare()
    with pytest.raises(StopIteration):
        lm.SpellModel._counts(rare)

    def total(counts):
        batches = [pa.RecordBatch.from_pydict({"word": [b"x"], "cls": [0], "a": [a], "b": [1]}) for a in counts]
        tracemalloc.start()
        got = sum(np.frombuffer(n, "<f8").sum() for out in rare.task(iter(batches)) for n in out.column("counts").to_pylist())
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert got == 5 * 16 * (sum(counts) + len(counts))
        return peak

    assert total([1 << 27] * 5) < 6 * lm.SLOTS * 4 / 1e6
    total([3, 1 << 40, 1 << 27])

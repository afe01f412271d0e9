import random

import pytest

from tests.llm.conftest import clashing, frame
from tidewatch.llm import token_rollups as tr
from tidewatch.llm.textkit import scratch


def changes(spark, rows):
    return spark.createDataFrame(rows, tr.CHANGE)


def totals(store):
    return {(r["source"], r["language"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}


def apply(state, batch):
    order = {"delete": 1}
    last = {}
    for d, v, op, s, l, t, q in batch:
        if d is not None and v is not None and (q, order.get(op, 0)) >= last.get((d, v), ((-1, 0),))[0]:
            last[(d, v)] = ((q, order.get(op, 0)), None if op == "delete" else (s, l, t or 0))
    for k, (_, x) in last.items():
        state.pop(k, None)
        if x:
            state[k] = x


def test_random_batches_match_a_recount(spark):
    r = random.Random(6)
    store, state = tr.TokenRollup(spark, scratch(spark, "test")), {}
    for n in range(3):
        batch = [(r.choice([None, *range(12)]), r.choice(["a-1", "b-1"]), r.choice(["insert", "revise", "delete"]), r.choice(["x", "hot", None]), r.choice(["en", None]), r.randint(0, 9), q) for q in range(40)]
        assert store.commit(f"b{n}", changes(spark, batch)) and not store.commit(f"b{n}", changes(spark, batch))
        apply(state, batch)
        want = {}
        for (_, v), (s, l, t) in state.items():
            d, k = want.get((s, l, v), (0, 0))
            want[(s, l, v)] = (d + 1, k + t)
        assert {k: v for k, v in totals(store).items() if v != (0, 0)} == want
    assert store.committed() == ["b0", "b1", "b2"]


def test_a_batch_that_failed_before_its_commit_is_run_again(spark, monkeypatch):
    store = tr.TokenRollup(spark, scratch(spark, "test"))
    store.commit("1", changes(spark, [(1, "v", "insert", "s", "en", 5, 0)]))
    two = changes(spark, [(1, "v", "revise", "s", "en", 7, 0), (2, "v", "insert", "s", "en", 1, 0)])
    with monkeypatch.context() as m:
        m.setattr(tr, "claim", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.commit("2", two)
    assert totals(store) == {("s", "en", "v"): (1, 5)}
    assert store.commit("2", two) and totals(store) == {("s", "en", "v"): (2, 8)}


def test_any_text_is_a_batch_id(spark):
    store = tr.TokenRollup(spark, scratch(spark, "test"))
    one, two = changes(spark, [(1, "v", "insert", "s", "en", 10, 0)]), changes(spark, [(2, "v", "insert", "s", "en", 4, 0)])
    assert store.commit("x/y", one) and totals(store) == {("s", "en", "v"): (1, 10)}
    assert not store.commit("x/y", one) and totals(store) == {("s", "en", "v"): (1, 10)}
    assert store.commit("x", two) and store.commit("../ \u00e9=%", changes(spark, [])) and store.commit("", changes(spark, []))
    assert totals(store) == {("s", "en", "v"): (2, 14)} and store.committed() == ["x/y", "x", "../ \u00e9=%", ""]


@pytest.mark.parametrize("ids", [("a", "b"), ("a", "a")])
def test_interleaved_writers_lose_no_batch_and_count_none_twice(spark, monkeypatch, ids):
    """Both writers compute their batch from the same state before either commits."""
    import threading

    folder = scratch(spark, "test")
    tr.TokenRollup(spark, folder).commit("0", changes(spark, [(1, "v", "insert", "s", "en", 5, 0)]))
    meet, real, waited, done = threading.Barrier(2), tr.claim, set(), {}

    def together(*a):
        if threading.get_ident() not in waited:
            waited.add(threading.get_ident())
            meet.wait(60)
        return real(*a)

    monkeypatch.setattr(tr, "claim", together)

    def run(i):
        done[i] = tr.TokenRollup(spark, folder).commit(ids[i], changes(spark, [(1, "v", "revise", "s", "en", 6 if ids[0] == ids[1] else 6 + i, 0)]))

    threads = [threading.Thread(target=run, args=(i,)) for i in (0, 1)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    store = tr.TokenRollup(spark, folder)
    if ids[0] == ids[1]:
        assert sorted(done.values()) == [False, True] and store.committed() == ["0", "a"] and totals(store) == {("s", "en", "v"): (1, 6)}
    else:
        assert all(done.values()) and sorted(store.committed()) == ["0", "a", "b"]
        assert totals(store) == {("s", "en", "v"): (1, 7 if store.committed()[-1] == "b" else 6)}


def test_counts_of_odd_texts(spark):
    df = clashing(frame(spark, [(1, None), (2, ""), (3, "a b\tc,d"), (4, "w " * 30_000), (4, "w " * 30_000), (None, "x")]))
    store = tr.TokenRollup(spark, scratch(spark, "test"))
    store.commit("1", tr.counted(df, "insert"))
    assert totals(store) == {("s", "en", "words-1"): (4, 30_003), ("s", "en", "pieces-1"): (4, 30_005)}
    store.commit("2", tr.removed(df.where("doc_id = 4")))
    assert totals(store) == {("s", "en", "words-1"): (3, 3), ("s", "en", "pieces-1"): (3, 5)}


def test_empty_batches_commit(spark):
    store = tr.TokenRollup(spark, scratch(spark, "test"))
    assert store.totals().count() == 0 and store.commit("0", changes(spark, [])) and store.totals().count() == 0


def test_public_bpe_vocabulary(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    path = str(tokenizers.path("byte_bpe_50k.tiktoken"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "Hello, world!", "naïve words  and\nlines"]
    got = tr.counted(frame(spark, texts), "insert", versions={"bpe": tr.bpe_counter(path, tokenizers.PATTERN)}).collect()
    assert {r["doc_id"]: r["tokens"] for r in got} == {i: len(own.encode_ordinary(t or "")) for i, t in enumerate(texts)}

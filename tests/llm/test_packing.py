import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.packing import closest_fill, pack, plan, unpacked_ids

VOCABULARY = path("byte_bpe_50k.json")


def ids_of(text):
    t = Tokenizer.from_file(VOCABULARY)
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def check(docs, rows, capacity):
    """Every id in one piece, sequences gapless and full but one."""
    want = {i: ids_of(t) for i, t in docs}
    got, seqs = {}, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(got) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(got[i], key=lambda r: r.start):
            own = ids[r.start:r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
            if r.ids is not None:
                assert unpacked_ids(r.ids) == own
            at += r.length
        assert at == len(ids)
    sums = []
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        sums.append(at)
    assert max(sums) <= capacity and sum(s < capacity for s in sums) <= 1
    return sums


@pytest.mark.parametrize("keep_ids", [False, True])
def test_pieces_cover_the_documents_and_fill_their_sequences(spark, keep_ids):
    r = random.Random(5)
    docs = [(i, prose(i, r.choice((3, 40, 41, 200, 900)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "  two  spaces\n\n and a line "), (103, "<|endoftext|> in <|endoftext|>text"), (104, "é   x 日本 語 " * 5), (105, "a" * 4000)]
    rows = pack(clashing(frame(spark, docs)).repartition(5), VOCABULARY, 128, keep_ids).collect()
    check(docs, rows, 128)


def test_all_pieces_longer_than_half_a_window_are_cut_to_fill(spark):
    docs = [(i, " ".join(["word"] * 70)) for i in range(50)]
    sums = check(docs, pack(frame(spark, docs), VOCABULARY, 128).collect(), 128)
    assert len(sums) == -(-50 * len(ids_of(docs[0][1])) // 128)


def test_very_long_text_repeated_rows_null_ids_and_empty_table(spark):
    long = prose(3, 300000)
    rows = pack(frame(spark, [(1, long)]), VOCABULARY).collect()
    check([(1, long)], rows, 1024)
    twice = pack(frame(spark, [(1, "one two"), (1, "one two"), (None, "x")]), VOCABULARY, 16).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in twice) == [(-1, 2), (1, 3), (1, 3)]
    assert len({(r.sequence_id, r.offset) for r in twice}) == 3
    assert pack(frame(spark, []), VOCABULARY).collect() == []


def test_fill_is_the_closest_there_is():
    r = random.Random(2)
    for _ in range(200):
        counts = {n: r.randint(1, 3) for n in r.sample(range(1, 60), r.randint(1, 6))}
        got = closest_fill(counts, 64)
        seed = max(counts)
        assert all(c <= counts[n] for n, c in got.items()) and got[seed] >= 1
        items = [n for n, c in counts.items() for _ in range(c - (n == seed))]
        sums = {seed}
        for n in items:
            sums |= {s + n for s in sums if s + n <= 64}
        assert sum(n * c for n, c in got.items()) == max(sums)


def test_plan_of_many_equal_lengths_stays_small():
    rows, windows = plan({600: 10 ** 9, 424: 10, 7: 10 ** 8})
    assert windows == -(-(600 * 10 ** 9 + 4240 + 7 * 10 ** 8) // 1024)
    assert sum(map(len, rows)) < 20000

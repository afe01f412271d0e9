import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.alignment import align_tokenizers, id_map
from tidewatch.llm.tokens import byte_level_bytes, pieces

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(docs):
    """Whole-text encodings, every overlap of byte ranges."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes, b_bytes = byte_level_bytes(A), pieces(B)[1]
    one, holding = [], Counter()
    for _, text in docs:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes[i] for i in x) != whole or b"".join(b_bytes[i] for i in y) != whole:
            x, y = [], []

        def ranges(ids, table):
            out, at = [], 0
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            return out

        rx, ry = ranges(x, a_bytes), ranges(y, b_bytes)
        links = [(i, j) for s, e, i in rx for s2, e2, j in ry if s < e2 and s2 < e]
        holding.update(set(links))
        cuts = sorted({e for _, e, _ in rx} & {e for _, e, _ in ry})
        groups, low = [], 0
        for c in cuts:
            inside = lambda r: ",".join(str(i) for s, e, i in r if low < e <= c)  # noqa: B023, E731
            groups.append(inside(rx) + "|" + inside(ry))
            low = c
        one.append((len(x), len(y), groups, links))
    top = defaultdict(int)
    for (i, _), n in holding.items():
        top[i] = max(top[i], n)
    out = []
    for (doc, _), (n_a, n_b, groups, links) in zip(docs, one):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc, n_a, n_b, len(groups), len(links), sum(holding[p] == top[p[0]] for p in links), sum(holding[p] for p in links), digest))
    return out, holding, top


def key(r):
    return tuple((x is None, x) for x in r)


def run(spark, docs, **options):
    got = align_tokenizers(clashing(frame(spark, docs)).repartition(3), A, B, **options)
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=key)


DOCS = [(i, prose(i, 60)) for i in range(12)] + [
    (20, None), (21, ""), (22, " "), (23, "  two  spaces\n\n and a line \t x "), (24, "<|endoftext|> in <s>text</s> <unk>"),
    (25, "é   x 日本 語 naïve café's don't 12345 $%&"), (26, "a" * 300), (27, "▁ marked ▁text"), (28, "zero\x00 byte \x1c y"),
    (29, "　wide line \u0085 next"), (30, "emoji 🙂🙃 and \U0001F468‍\U0001F469"), (31, "tail "), (31, "tail "), (None, "no id here")]


@pytest.mark.parametrize("options", [{}, {"shard_pairs": 50}])
def test_matches_whole_text_encodings(spark, options):
    assert run(spark, DOCS, **options) == sorted(brute(DOCS)[0], key=key)


def test_random_bytes_of_text(spark):
    r = random.Random(7)
    alphabet = "ab  \n\t.,'éß 日🙂 \u0085▁<>|x1"
    docs = [(i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))) for i in range(150)]
    assert run(spark, docs) == sorted(brute(docs)[0], key=key)


def test_very_long_text_and_empty_table(spark):
    text = prose(1, 20000)
    (row,) = run(spark, [(1, text)])
    a = Tokenizer.from_file(A).encode(" " + text, add_special_tokens=False).ids
    assert row[1] == len(a) and row[2] == len(sentencepiece.SentencePieceProcessor(model_file=B).encode(text))
    assert run(spark, []) == []


def test_id_map_holds_the_best_pairs(spark):
    docs = DOCS[:12]
    _, holding, top = brute(docs)
    want = {(i, j, n) for (i, j), n in holding.items() if n == top[i]}
    assert {tuple(r) for r in id_map(frame(spark, docs), A, B).collect()} == want

import hashlib
import random

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.lines import line_digest, line_sequence, repeated_runs, without_repeated_lines


def filled(t):
    return [(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")]


def brute(docs, min_lines=2, min_words=20):
    seen, out = {}, []
    order = sorted((d, t) for d, t in docs if d is not None)
    unique = dict(order)
    gone = {d: set() for d in unique}
    for d, t in sorted(unique.items()):
        f = filled(t)
        for k in range(len(f)):
            for size, least in ((min_lines, 0), (1, min_words)):
                run = tuple(x for _, x in f[k:k + size])
                if len(run) == size and len(run[0].split()) >= least:
                    if (size, run) in seen:
                        gone[d] |= {i for i, _ in f[k:k + size]}
                    seen.setdefault((size, run), (d, k))
    for d, t in docs:
        lines = (t or "").split("\n")
        cut = gone.get(d, set())
        kept = "\n".join(x for i, x in enumerate(lines) if i not in cut)
        out.append((d, len(filled(t)), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(2)
    pool = [prose(i, r.randint(1, 8)) for i in range(12)] + [prose(50 + i, 25) for i in range(3)] + ["", "  ", "\t"]
    docs = [(i, "\n".join(r.choice(pool) if r.random() < 0.7 else prose(r.random(), 5, 9999) for _ in range(r.randint(1, 14)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, "x\n" * 40), (64, docs[3][1]), (65, docs[3][1] + "\nend"), (5, docs[5][1]), (None, docs[3][1]), (66, "\n".join(f"line {i}" for i in range(700))), (67, "\n".join(f"line {i}" for i in range(5, 699)))]
    return docs


def test_matches_brute_force(spark):
    docs = corpus()
    got = line_digest(clashing(frame(spark, docs)).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_runs_reach_their_full_length(spark):
    a = [f"a {i}" for i in range(9)]
    docs = [(1, "\n".join(a)), (2, "\n".join(["x", *a[2:7], "y"])), (3, "\n".join(a[4:]))]
    lines = line_sequence(frame(spark, docs))
    at = {r["g"]: (r["doc_id"], r["i"]) for r in lines.collect()}
    runs = {at[r["g"]]: (at[r["first"]], r["n_lines"]) for r in repeated_runs(lines).collect()}
    assert runs[(2, 1)] == ((1, 2), 5) and runs[(2, 4)] == ((1, 5), 2) and runs[(3, 0)] == ((1, 4), 5)
    assert (1, 0) not in runs and (2, 0) not in runs


def test_columns_stay_and_null_texts_stay(spark):
    df = clashing(frame(spark, [(1, "a\nb\nc"), (2, "x\na\nb\n\ny"), (3, None)]))
    out = without_repeated_lines(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a\nb\nc", 2: "x\n\ny", 3: None}


def test_main_path_has_no_python(spark):
    plan = line_digest(frame(spark, [(1, "a\nb")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert line_digest(frame(spark, [])).count() == 0

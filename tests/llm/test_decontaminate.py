import hashlib
import re

from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.decontaminate import contaminated_spans, contamination, decontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, width=10):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[a:a + width]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                if (k := tuple(w[a:a + size])) in windows:
                    hit |= set(range(a, a + size))
                    ids |= windows[k]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def setting(spark):
    items = [(1, prose(1, 30)), (2, "Short item!"), (10, None), (11, ""), (12, "ünïcode Wörds 1,2,3 here"), (13, prose(1, 30)), (14, "?!")]
    long = items[0][1].upper().replace(" ", ",  ")
    docs = [(0, None), (1, ""), (2, prose(2, 400) + " " + long + " " + prose(3, 50)), (3, "x short ITEM y"), (4, "short"), (5, prose(4, 20_000)),
            (6, "ünïcode WöRDS-1 2 3 here short item"), (6, "ünïcode WöRDS-1 2 3 here short item"), (None, "a short item"), (8, " ".join(items[0][1].split()[:9]))]
    return docs, items, frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(spark):
    docs, items, d, b = setting(spark)
    want = brute(docs, items)
    assert sorted(map(tuple, contamination(d, b).collect()), key=repr) == want
    assert sorted(map(tuple, contamination(clashing(d).repartition(3), b, automaton_bytes=40).collect()), key=repr) == want


def test_spans_point_into_the_original(spark):
    docs, items, d, b = setting(spark)
    text = dict(docs)
    rows = contaminated_spans(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} >= {(2, "1"), (2, "13"), (3, "2"), (6, "12")}
    assert {text[r["doc_id"]][r["start"]:r["end"]].lower() for r in rows if r["item_id"] == "2"} == {"short item"}
    item = items[0][1].split()
    found = {tuple(WORD.findall(text[2][r["start"]:r["end"]].translate(LOWER))) for r in rows if r["doc_id"] == 2 and r["item_id"] == "1"}
    assert found == {tuple(item[i:i + 10]) for i in range(21)}


def test_documents_with_hits_go(spark):
    _, _, d, b = setting(spark)
    left = decontaminated(clashing(d), b)
    assert left.columns == clashing(d).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 4, 5, 8]


def test_empty_tables(spark):
    _, _, d, b = setting(spark)
    assert contamination(d.where("false"), b).count() == 0
    assert not any(r["contaminated"] for r in contamination(d, b.where("false")).collect())


def test_a_benchmark_of_any_size_is_scanned_in_shares(spark):
    """Shares of 40 bytes: every item alone, or nearly; results stay the same."""
    docs, items, d, b = setting(spark)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(contaminated_spans(d, b, automaton_bytes=40)) == rows(contaminated_spans(d, b))
    for least in (0.0, 0.2):
        small, whole = (decontaminated(clashing(d), b, min_share=least, automaton_bytes=n) for n in (40, 1 << 20))
        assert small.columns == whole.columns and rows(small) == rows(whole)
    assert contamination(d.where("false"), b, automaton_bytes=40).count() == 0

"""Detectors against brute force on random small inputs (Hypothesis)."""

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.operators.detect import ioc_match, pair_activity
from tests.conftest import T0, log_rows
from tests.test_ioc_match import base_iocs

record = st.fixed_dictionaries({
    "ms": st.integers(min_value=0, max_value=150_000),
    "uid": st.sampled_from(["C1", "C2", "C3", None]),
    "orig": st.sampled_from(["10.10.10.1", "10.10.10.2"]),
    "resp": st.sampled_from(["6.6.6.6", "9.9.9.9", "10.0.0.53"]),
    "port": st.one_of(st.none(), st.integers(min_value=1, max_value=12)),
    "bytes": st.one_of(st.none(), st.integers(min_value=0, max_value=60_000_000)),
    "query": st.sampled_from([None, "bad.example", "ok.example"]),
    "answers": st.sampled_from([None, [], ["7.7.7.7"], ["1.1.1.1", "2.2.2.2"]]),
    "host": st.sampled_from([None, "bad.example", "x.example"]),
})


def to_rows(recs):
    return [dict(ts=T0 + dt.timedelta(milliseconds=r["ms"]), uid=r["uid"], log_path="conn", id_orig_h=r["orig"],
                 id_resp_h=r["resp"], id_resp_p=r["port"], orig_bytes=r["bytes"], query=r["query"],
                 answers=r["answers"], host=r["host"]) for r in recs]


def expected_pairs(recs):
    groups = defaultdict(list)
    for r in recs:
        groups[(r["ms"] // 60_000, r["orig"], r["resp"])].append(r)
    out = set()
    for (w, o, p), rs in groups.items():
        ports = {r["port"] for r in rs if r["port"] is not None}
        first = min(rs, key=lambda r: (r["ms"], r["uid"] is not None, r["uid"] or ""))
        if len(ports) >= 8:
            out.add(("Port Scanning", o, p, "High" if len(ports) > 12 else "Medium", None, first["ms"]))
        total = sum(r["bytes"] for r in rs if r["bytes"] is not None)
        if any(r["bytes"] is not None for r in rs) and total > 100_000_000:
            out.add(("Data Exfiltration", o, p, "High" if total > 200_000_000 else "Medium", first["uid"], first["ms"]))
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(record, min_size=1, max_size=40))
def test_pair_detectors_match_brute_force(spark, recs):
    got = {(r.alert_type, r.orig_ip, r.resp_ip, r.severity, r.log_uid,
            (r.event_ts - T0) // dt.timedelta(milliseconds=1))
           for r in pair_activity(log_rows(spark, to_rows(recs)), exact=True).collect()}
    assert got == expected_pairs(recs)


# Match keys of `base_iocs`: indicator values per key, and the flags.
KEYS = {"bad.example": {"http://bad.example/x", "http://bad.example/y"}, "6.6.6.6": {"6.6.6.6:80"},
        "7.7.7.7": {"7.7.7.7"}}


def expected_iocs(recs):
    groups = defaultdict(list)
    for r in recs:
        answers = r["answers"] or [None]
        for a in answers:
            for v in (r["resp"], r["query"], a, r["host"]):
                if v in KEYS:
                    groups[(r["ms"] // 5000, r["uid"])].append((r, v))
    out = set()
    for (w, uid), hits in groups.items():
        first = min(hits, key=lambda h: (h[0]["ms"], h[0]["resp"], h[0]["orig"]))[0]
        values = sorted(set().union(*[KEYS[v] for _, v in hits]))
        out.add((uid, first["ms"], first["resp"], first["orig"], tuple(values)))
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(record, min_size=1, max_size=40))
def test_ioc_match_matches_brute_force(spark, recs):
    got = {(r.log_uid, (r.event_ts - T0) // dt.timedelta(milliseconds=1), r.resp_ip, r.orig_ip, tuple(r.ioc_value))
           for r in ioc_match(log_rows(spark, to_rows(recs)), base_iocs(spark)).collect()}
    assert got == expected_iocs(recs)

"""Port-scan and exfiltration boundaries (hand-written scenario rows)."""

import pytest

from tidewatch.operators.detect import data_exfiltration, pair_activity, port_scan
from tests.conftest import at, log_rows


def scan_rows(n_ports, start=0.0, pair=("10.10.10.5", "203.0.113.9"), step=0.2):
    return [dict(ts=at(start + i * step), uid=f"C{i}", log_path="conn", id_orig_h=pair[0],
                 id_resp_h=pair[1], id_resp_p=1000 + i) for i in range(n_ports)]


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("ports,expect", [(7, None), (8, "Medium"), (12, "Medium"), (13, "High")])
def test_port_scan_thresholds(spark, ports, expect, exact):
    out = port_scan(log_rows(spark, scan_rows(ports)), exact=exact).collect()
    if expect is None:
        assert out == []
    else:
        assert [r.severity for r in out] == [expect]
        r = out[0]
        assert r.alert_type == "Port Scanning" and r.log_uid is None and r.ioc_score is None
        assert r.tags == ["port_scan", f"ports_count:{ports}"]
        assert r.ioc_source == [] and r.ioc_value == []
        assert r.event_ts == at(0)


def test_scan_split_across_minute_edge_does_not_fire(spark):
    rows = scan_rows(7, start=52.0, step=1.0) + [
        dict(r, id_resp_p=r["id_resp_p"] + 100) for r in scan_rows(6, start=60.0, step=1.0)]
    assert port_scan(log_rows(spark, rows), exact=True).count() == 0


def test_scan_counts_distinct_ports_per_pair_only(spark):
    rows = scan_rows(5) + scan_rows(5, pair=("10.10.10.6", "203.0.113.9"))
    rows += [dict(r, id_resp_p=2000 + i) for i, r in enumerate(scan_rows(5))]
    out = port_scan(log_rows(spark, rows), exact=True).collect()
    assert [(r.orig_ip, r.tags[1]) for r in out] == [("10.10.10.5", "ports_count:10")]


def exfil_rows(total, chunks=1, start=0.0):
    per, rest = divmod(total, chunks)
    return [dict(ts=at(start + 2 * i), uid=f"X{i}", log_path="conn", id_orig_h="10.10.10.7",
                 id_resp_h="198.18.0.1", id_resp_p=443, orig_bytes=per + (rest if i == 0 else 0))
            for i in range(chunks)]


@pytest.mark.parametrize("total,expect", [
    (100_000_000, None), (100_000_001, "Medium"), (200_000_000, "Medium"), (200_000_001, "High")])
def test_exfiltration_thresholds(spark, total, expect):
    out = data_exfiltration(log_rows(spark, exfil_rows(total, chunks=3))).collect()
    assert [r.severity for r in out] == ([] if expect is None else [expect])
    if out:
        r = out[0]
        assert r.log_uid == "X0" and r.event_ts == at(0)
        assert r.tags == ["data_exfiltration", f"data_exfiltration_mb:{total / 1_000_000}"]


def test_exfiltration_ignores_rows_without_bytes(spark):
    rows = exfil_rows(60_000_000, chunks=2) + [
        dict(ts=at(1), uid="H1", log_path="http", id_orig_h="10.10.10.7", id_resp_h="198.18.0.1", host="x")]
    assert data_exfiltration(log_rows(spark, rows)).count() == 0


def test_redelivered_record_counts_twice_in_bytes(spark):
    rows = exfil_rows(60_000_000)
    assert data_exfiltration(log_rows(spark, rows + rows)).count() == 1


def test_first_uid_is_earliest_then_smallest(spark):
    rows = [dict(r, uid=u) for r, u in zip(exfil_rows(150_000_000, chunks=2), ["Cb", "Ca"])]
    rows.append(dict(rows[0], uid="Caa", orig_bytes=0))
    assert data_exfiltration(log_rows(spark, rows)).first().log_uid == "Caa"


def test_null_ts_rows_vanish(spark):
    rows = [dict(r, ts=None) for r in scan_rows(10)]
    assert pair_activity(log_rows(spark, rows), exact=True).count() == 0


def test_merged_pair_activity_equals_separate_detectors(spark):
    rows = scan_rows(13) + exfil_rows(250_000_000, chunks=3) + scan_rows(9, start=70)
    df = log_rows(spark, rows)
    both = {(r.alert_type, r.alert_id) for r in pair_activity(df, exact=True).collect()}
    sep = {(r.alert_type, r.alert_id) for r in
           port_scan(df, exact=True).unionByName(data_exfiltration(df)).collect()}
    assert both == sep and len(both) == 3


def test_alert_ids_are_replay_stable(spark):
    df = log_rows(spark, scan_rows(9))
    a = port_scan(df, exact=True).first().alert_id
    b = port_scan(df, exact=True).first().alert_id
    assert a == b and len(a) == 64

"""Bronze -> Silver edge cases (FIXTURES F2)."""
import datetime as dt
import json
import os
import tempfile

from conftest import ev
from pulsehouse.operators import silver
from pulsehouse.sources import bronze as bronze_io


def _rows(df):
    return {r.event_id: r for r in df.collect()}


def test_offset_moves_utc_date(spark, bronze_df):
    out = _rows(silver.transform(bronze_df([ev("a", "2026-06-17T23:30:00-02:00")])))
    assert out["a"].event_date == dt.date(2026, 6, 18)
    assert out["a"].event_hour == 1


def test_no_fraction_parsed(spark, bronze_df):
    out = _rows(silver.transform(bronze_df([ev("a", "2026-06-17T12:00:01+00:00")])))
    assert out["a"].event_hour == 12


def test_gates(spark, bronze_df):
    rows = [ev("bad_ts", "garbage"), ev("null_ts", None), ev(None), ev("null_svc", service=None),
            ev("empty_svc", service=""), ev("ok")]
    out = _rows(silver.transform(bronze_df(rows)))
    assert set(out) == {"empty_svc", "ok"}


def test_quarantine_reasons(spark, bronze_df):
    rows = [ev("bad_ts", "garbage"), ev(None), ev("null_svc", service=None), ev("ok")]
    got = {(r.event_id, r.reject_reason) for r in silver.quarantine(bronze_df(rows)).collect()}
    assert got == {("bad_ts", "bad_timestamp"), (None, "missing_event_id"),
                   ("null_svc", "missing_service")}


def test_status_boundaries_and_null(spark, bronze_df):
    rows = [ev("s399", status=399), ev("s400", status=400), ev("s499", status=499),
            ev("s500", status=500), ev("snull", status=None)]
    out = _rows(silver.transform(bronze_df(rows)))
    assert (out["s399"].is_error, out["s399"].is_server_error) == (False, False)
    assert (out["s400"].is_error, out["s400"].is_server_error) == (True, False)
    assert (out["s499"].is_error, out["s499"].is_server_error) == (True, False)
    assert (out["s500"].is_error, out["s500"].is_server_error) == (True, True)
    assert out["snull"].is_error is None and out["snull"].is_server_error is None


def test_exact_duplicate_one_row(spark, bronze_df):
    assert silver.transform(bronze_df([ev("d"), ev("d")])).count() == 1


def test_valid_twin_survives(spark, bronze_df):
    for det in (False, True):
        out = silver.transform(bronze_df([ev("d", "garbage"), ev("d")]), deterministic=det).collect()
        assert len(out) == 1 and out[0].event_ts is not None


def test_deterministic_dedup_picks_earliest(spark, bronze_df):
    rows = [ev("d", "2026-06-17T12:00:05+00:00", latency=5), ev("d", "2026-06-17T12:00:01+00:00", latency=1)]
    out = silver.transform(bronze_df(rows), deterministic=True).collect()
    assert out[0].latency_ms == 1


def test_json_permissive(spark):
    d = tempfile.mkdtemp(prefix="ph-json-")
    lines = [json.dumps(dict(zip(["event_id", "timestamp", "service", "status_code"],
                                 ["ok", "2026-06-17T12:00:00+00:00", "auth-api", 200]))),
             "{broken json",
             json.dumps({"event_id": "str", "timestamp": "2026-06-17T12:00:00+00:00",
                         "service": "auth-api", "status_code": "500"}),
             json.dumps({"event_id": "flt", "timestamp": "2026-06-17T12:00:00+00:00",
                         "service": "auth-api", "status_code": 12.7})]
    os.makedirs(os.path.join(d, "a", "b"))
    with open(os.path.join(d, "a", "b", "x.jsonl"), "w") as f:
        f.write("\n".join(lines))
    raw = bronze_io.scan(spark, d)
    assert raw.count() == 4
    out = _rows(silver.transform(raw))
    assert set(out) == {"ok", "str", "flt"}
    assert out["str"].status_code is None and out["str"].is_error is None
    assert out["flt"].status_code is None


def test_stage_counts(spark, bronze_df):
    rows = [ev("a"), ev("a"), ev("b", "garbage"), ev(None), ev("c")]
    r = silver.stage_counts(bronze_df(rows)).first()
    assert (r.raw_count, r.clean_count) == (5, 2)

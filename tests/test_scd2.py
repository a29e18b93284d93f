"""Type-2 snapshot cases (FIXTURES F4)."""
import datetime as dt

from pulsehouse.operators import scd2
from pulsehouse.schemas import USERS

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-15 00:00:00", "2024-02-01 00:00:00"
D = dt.date(2023, 5, 1)


def users(spark, rows):
    return spark.createDataFrame(rows, USERS)


def run(existing, src, ts):
    return scd2.snapshot_check(existing, src, "user_id", ["plan", "country"], ts)


def versions(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.user_id, []).append(r)
    for v in out.values():
        v.sort(key=lambda r: r.dbt_valid_from)
    return out


def test_check_strategy_cases(spark):
    s1 = users(spark, [("same", D, "free", "IN"), ("plan", D, "free", "IN"),
                       ("country", D, "free", "IN"), ("tonull", D, "free", "IN"),
                       ("fromnull", D, None, "IN"), ("signup", D, "free", "IN"),
                       ("missing", D, "free", "IN")])
    s2 = users(spark, [("same", D, "free", "IN"), ("plan", D, "premium", "IN"),
                       ("country", D, "free", "US"), ("tonull", D, None, "IN"),
                       ("fromnull", D, "free", "IN"), ("signup", dt.date(2020, 1, 1), "free", "IN"),
                       ("new", D, "enterprise", "DE")])
    v1 = run(None, s1, T1)
    v = versions(run(v1, s2, T2))
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 15)
    assert len(v["same"]) == 1 and v["same"][0].dbt_valid_to is None
    for k in ("plan", "country", "tonull", "fromnull"):
        old, new = v[k]
        assert old.dbt_valid_from == t1 and old.dbt_valid_to == t2
        assert new.dbt_valid_from == t2 and new.dbt_valid_to is None
    assert v["plan"][1].plan == "premium" and v["tonull"][1].plan is None
    # a column outside check_cols never versions; the old value stays
    assert len(v["signup"]) == 1 and v["signup"][0].signup_date == D
    assert len(v["missing"]) == 1 and v["missing"][0].dbt_valid_to is None
    assert len(v["new"]) == 1 and v["new"][0].dbt_valid_from == t2
    assert v["new"][0].dbt_scd_id != v["plan"][1].dbt_scd_id


def test_same_snapshot_twice_is_noop(spark):
    s1 = users(spark, [("a", D, "free", "IN"), ("b", D, None, None)])
    v1 = run(None, s1, T1)
    v2 = run(v1, s1, T2)
    assert sorted(map(tuple, v1.collect())) == sorted(map(tuple, v2.collect()))


def test_two_changes_three_versions(spark):
    v = run(None, users(spark, [("a", D, "free", "IN")]), T1)
    v = run(v, users(spark, [("a", D, "premium", "IN")]), T2)
    v = run(v, users(spark, [("a", D, "enterprise", "IN")]), T3)
    vs = versions(v)["a"]
    assert [r.plan for r in vs] == ["free", "premium", "enterprise"]
    assert vs[0].dbt_valid_to == vs[1].dbt_valid_from and vs[1].dbt_valid_to == vs[2].dbt_valid_from
    assert scd2.current(v).count() == 1
    assert scd2.as_of(v, "2024-01-20 00:00:00").first().plan == "premium"


def test_timestamp_strategy(spark):
    schema = "user_id string, plan string, updated_at timestamp_ntz"
    s1 = spark.createDataFrame([("a", "free", dt.datetime(2024, 1, 1)),
                                ("b", "free", dt.datetime(2024, 1, 1))], schema)
    s2 = spark.createDataFrame([("a", "free", dt.datetime(2024, 1, 9)),
                                ("b", "premium", dt.datetime(2024, 1, 1))], schema)
    v = versions(scd2.snapshot_timestamp(scd2.snapshot_timestamp(None, s1, "user_id"), s2, "user_id"))
    # newer updated_at versions even without a column change; same updated_at never does
    assert len(v["a"]) == 2 and v["a"][0].dbt_valid_to == dt.datetime(2024, 1, 9)
    assert len(v["b"]) == 1 and v["b"][0].plan == "free"


def test_stored_snapshot_keeps_closed_history_and_survives_a_failed_run(spark):
    import glob
    import os
    import pytest
    from pulsehouse.session import scratch_path
    base = scratch_path(spark, "t-store")

    def once(rows, at):
        return scd2.run_snapshot(spark, base, users(spark, rows), "user_id", ["plan", "country"], at)
    once([("a", D, "free", "IN"), ("b", D, "free", "IN")], T1)
    once([("a", D, "premium", "IN"), ("b", D, "free", "IN")], T2)
    closed = {f: os.path.getmtime(f) for f in glob.glob(f"{base.removeprefix('file:')}/run-*/closed/part-*")}
    want = sorted(map(str, scd2.read_history(spark, base).collect()))
    with pytest.raises(scd2.SnapshotKeyError):     # a run that fails changes nothing readers see
        once([("a", D, "x", "IN"), ("a", D, "y", "IN")], T3)
    assert sorted(map(str, scd2.read_history(spark, base).collect())) == want
    v = versions(once([("a", D, "enterprise", "IN"), ("b", D, "free", "IN")], T3))
    assert [r.plan for r in v["a"]] == ["free", "premium", "enterprise"] and len(v["b"]) == 1
    assert all(os.path.getmtime(f) == t for f, t in closed.items())


def test_null_and_repeated_keys_raise_or_are_rejected(spark):
    import pytest
    from pulsehouse.session import scratch_path
    rows = users(spark, [("a", D, "free", "IN"), (None, D, "free", "IN"), ("b", D, "free", "IN"), ("b", D, "pro", "IN")])
    with pytest.raises(scd2.SnapshotKeyError):
        run(None, rows, T1)
    with pytest.raises(scd2.SnapshotKeyError):
        run(run(None, users(spark, [("a", D, "free", "IN")]), T1), rows, T2)
    got = sorted((r.user_id or "", r.plan, r.reject_reason) for r in scd2.reject_keys(rows, "user_id").collect())
    assert got == [("", "free", "null_key"), ("b", "free", "repeated_key"), ("b", "pro", "repeated_key")]
    root = scratch_path(spark, "t-reject")
    kept = scd2.run_snapshot(spark, f"{root}/s", rows, "user_id", ["plan"], T1, rejects=f"{root}/r")
    assert [r.user_id for r in kept.collect()] == ["a"] and spark.read.parquet(f"{root}/r").count() == 3


def test_timestamp_strategy_ignores_older_updates(spark):
    schema = "user_id string, plan string, updated_at timestamp_ntz"
    s1 = spark.createDataFrame([("a", "free", dt.datetime(2024, 1, 9))], schema)
    s2 = spark.createDataFrame([("a", "premium", dt.datetime(2024, 1, 5))], schema)
    v = scd2.snapshot_timestamp(scd2.snapshot_timestamp(None, s1, "user_id"), s2, "user_id")
    rows = v.collect()
    assert len(rows) == 1 and rows[0].plan == "free" and rows[0].dbt_valid_to is None


def test_previous_version_with_reordered_columns(spark):
    v1 = run(None, users(spark, [("a", D, "free", "IN"), ("b", D, "free", "US")]), T1)
    shuffled = v1.select(*reversed(v1.columns))          # e.g. read back in another order
    v2 = run(shuffled, users(spark, [("a", D, "premium", "IN"), ("b", D, "free", "US")]), T2)
    by = versions(v2)
    assert [r.plan for r in by["a"]] == ["free", "premium"]
    assert by["b"][0].country == "US" and by["b"][0].dbt_valid_to is None
    assert by["a"][0].dbt_valid_to == dt.datetime(2024, 1, 15)

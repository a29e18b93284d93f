"""The stored snapshot: hash buckets, of which a run rewrites those with a change."""
import glob
import os

import pytest

from conftest import SF_SMALL
from pulsehouse.operators import scd2
from pulsehouse.plans import registry
from pulsehouse.session import scratch_path
from pulsehouse.sources import bridge, lake

USERS = "user_id string, signup_date date, plan string, country string"
CHECK = ["plan", "country"]


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def source(spark, changed=(), extra=0, n=300):
    rows = [(f"u{i}", None, "new" if i in changed else "old", None if i % 5 else "IN") for i in range(n + extra)]
    return spark.createDataFrame(rows, USERS)


def run(spark, base, rows, day, **more):
    return scd2.run_snapshot(spark, base, rows, "user_id", CHECK, f"2024-01-{day:02d} 00:00:00", **more)


def rewritten(base, run_name):
    return sorted(int(os.path.basename(p)[2:]) for p in glob.glob(f"{local(base)}/{run_name}/open/b=*"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_run_that_changes_one_key_writes_one_bucket(spark):
    base = scratch_path(spark, "t-snap")
    run(spark, base, source(spark), 1, buckets=16)
    history = run(spark, base, source(spark, changed={7}), 2)
    runs = lake.published(spark, base)
    assert len(rewritten(base, runs[0])) == 16 and len(rewritten(base, runs[1])) == 1
    want = scd2.snapshot_check(scd2.snapshot_check(None, source(spark), "user_id", CHECK, "2024-01-01 00:00:00"),
                               source(spark, changed={7}), "user_id", CHECK, "2024-01-02 00:00:00")
    assert rows_of(history) == rows_of(want)
    held = scd2.manifest(spark, base, runs[1])
    assert len(held) == 16 and sorted(held.values()).count(runs[1]) == 1


def test_runs_without_a_change_write_nothing_and_later_ones_go_on(spark):
    base = scratch_path(spark, "t-snap")
    plain = None
    plan = [((), 0), ((), 0), ({1, 2}, 0), ({1, 2}, 9), ((), 9)]
    for day, (changed, extra) in enumerate(plan, 1):
        rows = source(spark, changed, extra)
        history = run(spark, base, rows, day, buckets=8)
        plain = registry.materialized(scd2.snapshot_check(plain, rows, "user_id", CHECK, f"2024-01-{day:02d} 00:00:00"))
        assert rows_of(history) == rows_of(plain)
    runs = lake.published(spark, base)
    assert rewritten(base, runs[1]) == [] and len(rewritten(base, runs[2])) <= 2
    assert set(scd2.manifest(spark, base, runs[-1])) == set(range(8))


def test_a_key_missing_from_the_source_stays_open(spark):
    base = scratch_path(spark, "t-snap")
    run(spark, base, source(spark, n=50), 1, buckets=4)
    history = run(spark, base, source(spark, n=10), 2)
    assert history.count() == 50 and scd2.current(history).count() == 50


def test_null_and_empty_checked_values_differ(spark):
    base = scratch_path(spark, "t-snap")
    run(spark, base, spark.createDataFrame([("a", None, "p", None)], USERS), 1, buckets=2)
    history = run(spark, base, spark.createDataFrame([("a", None, "p", "")], USERS), 2)
    assert history.count() == 2
    assert run(spark, base, spark.createDataFrame([("a", None, "p", "")], USERS), 3).count() == 2


def test_a_failing_run_leaves_the_published_history(spark, monkeypatch):
    base = scratch_path(spark, "t-snap")
    before = rows_of(run(spark, base, source(spark, n=40), 1, buckets=4))
    monkeypatch.setattr(lake, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run(spark, base, source(spark, changed={3}, n=40), 2)
    monkeypatch.undo()
    assert rows_of(scd2.read_history(spark, base)) == before
    assert run(spark, base, source(spark, changed={3}, n=40), 2).count() == 41


def test_empty_source_and_store(spark):
    base = scratch_path(spark, "t-snap")
    assert run(spark, base, source(spark, n=0), 1, buckets=4).count() == 0
    assert run(spark, base, source(spark, n=5), 2).count() == 5
    assert run(spark, base, source(spark, n=0), 3).count() == 5


def test_a_store_without_buckets_gets_them(spark):
    base = scratch_path(spark, "t-snap")
    first = scd2.snapshot_check(None, source(spark, n=20), "user_id", CHECK, "2024-01-01 00:00:00")
    first.write.parquet(f"{base}/run-0/open")
    first.where("false").write.parquet(f"{base}/run-0/closed")
    lake.publish(spark, base, "run-0")
    assert run(spark, base, source(spark, changed={1}, n=20), 2).count() == 21
    assert len(scd2.manifest(spark, base, lake.published(spark, base)[-1])) == scd2.MIN_BUCKETS
    assert run(spark, base, source(spark, changed={1, 2}, n=20), 3).count() == 22


def test_comparing_reads_keys_and_checked_columns_only(spark):
    base = scratch_path(spark, "t-snap")
    run(spark, base, source(spark), 1, buckets=4)
    seen = []
    real = scd2.changed_buckets

    def spy(open_versions, rows, key, cols, n):
        old = open_versions.select(key, scd2._digest(cols))
        seen.append(old._jdf.queryExecution().executedPlan().toString())
        return real(open_versions, rows, key, cols, n)
    scd2.changed_buckets = spy
    try:
        run(spark, base, source(spark, changed={1}), 2)
    finally:
        scd2.changed_buckets = real
    assert "ReadSchema: struct<user_id:string,plan:string,country:string>" in seen[0]


def test_users_bridge_through_the_store(spark):
    got = rows_of(registry.REGISTRY["users_snapshot_sink"](spark, SF_SMALL))
    assert got == rows_of(registry.users_history(spark, SF_SMALL))
    _, s2 = bridge.users_snapshots(spark, SF_SMALL)
    assert s2.count() > 0

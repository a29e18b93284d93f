"""Streaming layers: parity with batch, late data, idempotent versioned sink."""
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pulsehouse.operators import marts, silver
from pulsehouse.plans import registry
from pulsehouse.session import scratch_path
from pulsehouse.streaming import live


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_stream_kpis_match_batch_mart(spark):
    streamed = registry.REGISTRY["stream_hourly_kpis"](spark, SF_SMALL)
    batch = registry.kpis_frame(spark, SF_SMALL)
    exact = [*registry.STREAM_EXACT_COLS, "unique_users"]     # users counted from the streaming Silver
    assert sorted(map(tuple, streamed.select(*exact).collect())) == sorted(map(tuple, batch.select(*exact).collect()))


def test_stream_user_estimate_is_close(spark):
    kpis = registry._streamed(spark, SF_SMALL, "kpis")[0]
    j = kpis.join(registry.kpis_frame(spark, SF_SMALL), live.KPI_KEYS)
    off = j.filter(F.abs(F.col("approx_unique_users") - F.col("unique_users"))
                   > F.greatest(F.lit(1), F.col("unique_users") * 0.05)).count()
    assert off == 0


def _event(i, ts, svc="auth-api", status=200):
    return json.dumps({"event_id": f"e{i}", "timestamp": ts, "service": svc, "endpoint": "/x",
                       "method": "GET", "status_code": status, "latency_ms": 10 * i,
                       "user_id": f"u{i}", "region": "r", "ip": "ip", "error_message": None})


def test_late_rows_dropped_and_windows_upserted(spark):
    root = scratch_path(spark, "t-stream")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    batches = [
        ("a.jsonl", [_event(1, "2024-01-01T10:10:00+00:00"), _event(2, "2024-01-01T12:05:00+00:00")]),
        ("b.jsonl", [_event(4, "2024-01-01T10:40:00+00:00", status=500),  # inside: updates 10:00
                     _event(2, "2024-01-01T12:05:00+00:00")]),               # replayed duplicate
        # late rows are judged against the previous batch's watermark (12:05 - 2h)
        ("c.jsonl", [_event(3, "2024-01-01T07:00:00+00:00")]),
    ]
    for n, (name, rows) in enumerate(batches):
        p = os.path.join(src, name)
        with open(p, "w") as f:
            f.write("\n".join(rows))
        os.utime(p, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))
    slv = live.silver_stream(live.bronze_stream(spark, src, max_files_per_trigger=1), "2 hours")
    q = live.start_kpis_sink(live.hourly_kpis_stream(slv), f"{root}/kpis", f"{root}/_ck")
    q.awaitTermination()
    got = {(r.event_hour, r.total_requests, r.error_count)
           for r in live.read_kpis_sink(spark, f"{root}/kpis").collect()}
    assert got == {(10, 2, 1), (12, 1, 0)}
    assert live.late_rows(q) >= 1       # the dropped row is counted
    # the sink kept both versions of the 10:00 window; the reader picks the latest
    versions = spark.read.parquet(f"{root}/kpis").filter("event_hour = 10").count()
    assert versions == 2


def test_replayed_batch_rewrites_its_own_folders(spark):
    from pulsehouse.operators import silver as silver_ops
    from pulsehouse.schemas import BRONZE
    from conftest import ev
    out = scratch_path(spark, "t-replay")
    write = live._batch_writer(out, ["event_date", "service"])
    b0 = silver_ops.transform(spark.createDataFrame([ev("a"), ev("b")], BRONZE))
    b1 = silver_ops.transform(spark.createDataFrame([ev("c", "2026-06-18T01:00:00+00:00")], BRONZE))
    write(b0, 0)
    write(b1, 1)
    write(b1, 1)          # the same micro-batch replayed after a failure
    write(b0, 0)          # and an older one
    got = sorted(r.event_id for r in live.read_silver_sink(spark, out).collect())
    assert got == ["a", "b", "c"]
    # one file per folder and batch, and fewer after compaction of closed dates
    import glob
    files = glob.glob(f"{local(out)}/event_date=*/service=*/batch_id=*/part-*")
    assert len(files) == 2
    for n in range(2, 6):
        write(b0.withColumn("event_id", F.concat("event_id", F.lit(str(n)))), n)
    target = scratch_path(spark, "t-compact")
    assert live.compact_silver(spark, out, target, "2026-06-18") == 10
    assert len(glob.glob(f"{local(target)}/event_date=2026-06-17/service=*/part-*")) == 1


def test_stream_cli_catch_up_pass(spark):
    from pulsehouse.__main__ import main
    from pulsehouse.sources import bridge
    from pulsehouse.sources import bronze as bronze_io
    root = scratch_path(spark, "t-streamcli")
    bronze_io.land(bridge.bronze(spark, SF_SMALL, dirty=True), f"{root}/bronze", mode="overwrite")
    main(["stream", "--input", f"{root}/bronze", "--silver", f"{root}/silver",
          "--kpis", f"{root}/kpis", "--users", f"{root}/users", "--checkpoint", f"{root}/ck"], spark)
    assert live.read_users_sink(spark, f"{root}/users").count() > 0
    batch = registry.silver_frame(spark, SF_SMALL).count()
    assert live.read_silver_sink(spark, f"{root}/silver").count() == batch
    assert live.read_kpis_sink(spark, f"{root}/kpis").agg(F.sum("total_requests")).first()[0] == batch


def _put(src, name, rows, at):
    p = os.path.join(src, name)
    with open(p, "w") as f:
        f.write("\n".join(rows))
    os.utime(p, (1_700_000_000 + at, 1_700_000_000 + at))


def _visit(i, ts, user, svc="auth-api"):
    return json.dumps({**json.loads(_event(i, ts, svc)), "user_id": user})


VISITS = [
    [_visit(1, "2024-01-01T10:10:00+00:00", "a"), _visit(2, "2024-01-01T10:50:00+00:00", "a"),
     _visit(3, "2024-01-01T10:20:00+00:00", "b"), _visit(4, "2024-01-01T10:30:00+00:00", None),
     _visit(5, "2024-01-01T10:30:00+00:00", None, "user-svc"), _visit(6, "2024-01-01T11:59:00+00:00", "a")],
    # an hour later: the same users again, a replayed event, a new user in the first hour
    [_visit(7, "2024-01-01T10:59:59+00:00", "b"), _visit(1, "2024-01-01T10:10:00+00:00", "a"),
     _visit(8, "2024-01-01T10:00:00+00:00", "c"), _visit(9, "2024-01-01T12:40:00+00:00", "a")],
    [_visit(10, "2024-01-01T15:00:00+00:00", "z")],
    [_visit(11, "2024-01-01T10:30:00+00:00", "late")],          # later than the watermark
    [_visit(12, "2024-01-01T20:00:00+00:00", "z")],
]


def _users(spark, root, src, files=1):
    slv = live.silver_stream(live.bronze_stream(spark, src, max_files_per_trigger=files), "2 hours")
    q = live.start_users_sink(live.distinct_users_stream(slv), f"{root}/users", f"{root}/_ck")
    q.awaitTermination()
    return q


def _counted(spark, root):
    return sorted((r.service, r.event_hour, r.unique_users) for r in live.read_users_sink(spark, f"{root}/users").collect())


WANT = [("auth-api", 10, 3), ("auth-api", 11, 1), ("auth-api", 12, 1), ("auth-api", 15, 1), ("user-svc", 10, 0)]


def test_distinct_users_are_counted_in_the_stream(spark):
    root = scratch_path(spark, "t-users")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    for n, rows in enumerate(VISITS):
        _put(src, f"{n}.jsonl", rows, 10 * n)
    q = _users(spark, root, src)
    assert _counted(spark, root) == WANT
    assert live.late_rows(q) >= 1
    assert live.state_size(q)["stages"] == 3


def test_distinct_users_go_on_after_a_restart_and_a_replay(spark):
    """One query per file over one checkpoint: the state comes back from it; a batch written twice counts once."""
    root = scratch_path(spark, "t-restart")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    for n, rows in enumerate(VISITS):
        _put(src, f"{n}.jsonl", rows, 10 * n)
        _users(spark, root, src)
    assert _counted(spark, root) == WANT
    # replay: the commit of the last batches is lost, they run again into the same folders
    import glob
    commits = sorted(glob.glob(f"{local(root)}/_ck/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for p in commits[-1:]:
        os.remove(p)
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    _users(spark, root, src)
    assert _counted(spark, root) == WANT


def test_a_user_with_most_requests_is_one_state_row_an_hour(spark):
    root = scratch_path(spark, "t-hotuser")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    _put(src, "a.jsonl", [_visit(i, "2024-01-01T10:10:00+00:00", "hot") for i in range(2000)], 0)
    q = _users(spark, root, src)
    stages = [o for p in q.recentProgress for o in p.stateOperators if p.numInputRows]
    assert sorted(o.numRowsTotal for o in stages)[:2] == [1, 1]


def test_state_is_kept_in_rocksdb(spark):
    root = scratch_path(spark, "t-rocks")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    _put(src, "a.jsonl", VISITS[0], 0)
    q = _users(spark, root, src)
    ops = [o for p in q.recentProgress for o in p.stateOperators]
    assert ops and all(any(k.startswith("rocksdb") for k in o.customMetrics) for o in ops)
    assert live.state_size(q)["bytes"] > 0
    # a batch's checkpoint is its changes
    import glob
    assert glob.glob(f"{local(root)}/_ck/state/**/*.changelog", recursive=True)


def test_a_stream_batch_writes_one_file_per_folder(spark):
    """The stateful query has a task per state partition; its rows are gathered by folder before they are written."""
    import glob
    root = scratch_path(spark, "t-files")
    src = os.path.join(local(root), "bronze")
    os.makedirs(src)
    _put(src, "a.jsonl", [_visit(i, f"2024-01-0{1 + i % 2}T10:10:00+00:00", f"u{i}", ("auth-api", "user-svc")[i // 2 % 2])
                          for i in range(200)], 0)
    slv = live.silver_stream(live.bronze_stream(spark, src), "2 days")
    live.start_silver_sink(slv, f"{root}/silver", f"{root}/_ck_silver").awaitTermination()
    live.start_kpis_sink(live.hourly_kpis_stream(slv), f"{root}/kpis", f"{root}/_ck_kpis").awaitTermination()
    files = glob.glob(f"{local(root)}/silver/event_date=*/service=*/batch_id=0/part-*")
    assert len(files) == 4 and live.read_silver_sink(spark, f"{root}/silver").count() == 200
    assert len(glob.glob(f"{local(root)}/kpis/event_date=*/batch_id=0/part-*")) == 2
    assert sorted((r.service, r.event_hour, r.total_requests) for r in live.read_kpis_sink(spark, f"{root}/kpis").collect()) == [
        ("auth-api", 10, 50)] * 2 + [("user-svc", 10, 50)] * 2

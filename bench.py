"""Bench: the lake built the way it runs in production, stage by stage.

Bronze landing -> Silver job -> catalog registration -> Gold build (with its
checks), then the dashboard and ad-hoc queries on the written tables, the
users snapshot and the dimension joins. Every timed step runs its whole plan
(writes, or a ``noop`` write for queries). Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsehouse.operators import enrich, scd2, serving, serving_sql, silver  # noqa: E402
from pulsehouse.plans import jobs, registry  # noqa: E402
from pulsehouse.session import build_session, scratch_path  # noqa: E402
from pulsehouse.sources import bridge, lake  # noqa: E402
from pulsehouse.sources import bronze as bronze_io  # noqa: E402
from pulsehouse.streaming import live  # noqa: E402


def _mb(path: str) -> float | None:
    """Data bytes below a local folder (checksum and marker files excluded)."""
    local = path[len("file:"):] if path.startswith("file:") else path
    if not os.path.isdir(local):
        return None
    total = 0
    for d, _, files in os.walk(local):
        total += sum(os.path.getsize(os.path.join(d, f)) for f in files
                     if not f.startswith((".", "_")))
    return round(total / 1e6, 2)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "8g",
             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pulsehouse-bench-")}
    if os.environ.get("BENCH_EVENT_LOG") == "1":
        log_dir = tempfile.mkdtemp(prefix="pulsehouse-eventlog-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"})
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = build_session(f"local[{cpus}]", app="pulsehouse-bench", shuffle_partitions=cpus,
                          extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    root = scratch_path(spark, "bench")
    bronze_path, silver_path, gold_dir = f"{root}/bronze", f"{root}/silver", f"{root}/gold"

    # warm the JVM once (class loading, codegen caches) outside the numbers
    run(registry.REGISTRY["service_health"](spark, "/root/testdata/sf0.001"))

    timed("bronze_land", lambda: bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True),
                                                bronze_path, mode="overwrite"))
    timed("silver_job", lambda: jobs.run_silver(spark, bronze_path, silver_path))
    timed("catalog_register", lambda: lake.register_partitioned(spark, silver_path))
    timed("gold_build", lambda: jobs.build_gold(spark, silver_path, gold_dir))

    results = jobs.serving_results(spark, gold_dir)
    for key, name in [("service-health", "service_health"), ("error-trend", "error_rate_trend"),
                      ("latency", "latency_percentiles"), ("active-users", "daily_active_users")]:
        timed(name, lambda df=results[key]: run(df))

    marts = {n: spark.read.parquet(p) for n, p in jobs.gold_paths(spark, gold_dir).items()}
    timed("sql_server_share_by_day", lambda: run(serving_sql.run(
        spark, serving_sql.SERVER_SHARE_BY_DAY, kpis=marts["mart_service_hourly_kpis"])))
    timed("export", lambda: jobs.export_snapshot(spark, gold_dir, f"{root}/export"))
    timed("silver_job_quarantine", lambda: jobs.run_silver(
        spark, bronze_path, f"{root}/silver2", quarantine_path=f"{root}/rejects"))
    slv = live.silver_stream(live.bronze_stream(spark, bronze_path))
    timed("stream_silver", lambda: live.start_silver_sink(
        slv, f"{root}/stream_silver", f"{root}/_ck_silver").awaitTermination())

    stg = silver.staging(lake.read_silver(spark, silver_path))
    timed("p95_by_service", lambda: run(serving.p95_by_service(stg)))
    timed("traffic_by_hour", lambda: run(serving.traffic_by_hour(stg)))
    timed("top_users", lambda: run(serving.top_users(stg)))

    history_path = scratch_path(spark, "bench-users")
    timed("users_scd2", lambda: [scd2.run_snapshot(spark, history_path, u, "user_id", ["plan", "country"], at)
                                 for u, at in zip(bridge.users_snapshots(spark, sf_dir),
                                                  (bridge.SNAPSHOT_1_AT, bridge.SNAPSHOT_2_AT))])
    history = scd2.read_history(spark, history_path)
    timed("kpis_by_plan", lambda: run(enrich.kpis_by_dimension(stg, scd2.current(history), ["plan"])))
    timed("events_asof_plan", lambda: run(enrich.kpis_point_in_time(stg, history)))
    kpis = marts["mart_service_hourly_kpis"]
    timed("hour_over_hour_self", lambda: run(enrich.hour_over_hour(kpis)))
    timed("service_rank_hourly", lambda: run(enrich.service_rank_hourly(kpis)))

    # the flagship as one lazy plan straight from the source tables
    timed("service_health_end_to_end",
          lambda: run(registry.REGISTRY["service_health"](spark, sf_dir)))

    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    bronze_mb, silver_mb = _mb(bronze_path), _mb(silver_path)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "bronze_mb": bronze_mb, "silver_mb": silver_mb,
                      "bronze_to_silver_size_ratio":
                          round(bronze_mb / silver_mb, 2) if silver_mb else None}))
    spark.stop()


if __name__ == "__main__":
    main()

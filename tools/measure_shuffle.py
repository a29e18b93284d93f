"""Shuffle bytes and seconds of plans that compete for the same result, from Spark's event log.

usage: python tools/measure_shuffle.py dedup|marts [--sf DIR] [--copies N]

``dedup``: the aggregation on event_id against the filter of repeated keys, at several
shares of repeated events. ``marts``: exact distinct users against stored sketches, few
and many users per group. Rows come from the events table, ``copies`` times with other
ids. Every plan runs twice in one session; the second run counts.
"""
from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pulsehouse.operators import marts, silver  # noqa: E402
from pulsehouse.plans.registry import materialized  # noqa: E402
from pulsehouse.session import build_session  # noqa: E402
from pulsehouse.sources import bridge  # noqa: E402


def shuffled(log_dir: str, group: str) -> tuple[float, float]:
    """(MB written to shuffles, MB spilled) by the tasks of a job group."""
    stages, mb, spill = set(), 0, 0
    path = sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p))
    for line in (x for p in path for x in open(p) if x.startswith("{")):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
            stages.update(e["Stage IDs"])
        elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages and e.get("Task Metrics"):
            mb += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
            spill += e["Task Metrics"]["Disk Bytes Spilled"]
    return mb / 1e6, spill / 1e6


def many(spark, sf: str, copies: int):
    """The clean events, ``copies`` times with ids of their own."""
    rows = bridge.bronze(spark, sf, dirty=False).drop("arrival_ts")
    return rows.crossJoin(spark.range(copies).withColumnRenamed("id", "_n")).withColumn(
        "event_id", F.concat("event_id", F.lit("-"), F.col("_n"))).drop("_n")


def dedup_plans(spark, sf, copies):
    rows = many(spark, sf, copies)
    for share in (0, 1, 10, 50):
        twice = F.pmod(F.xxhash64("event_id"), F.lit(100)) < share
        with_twins = rows.withColumn("_c", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        valid = materialized(silver.valid(with_twins.drop("_c")))
        yield f"dedup {share} % repeated, aggregation", lambda v=valid: silver.dedup(v, True)
        yield f"dedup {share} % repeated, filter", lambda v=valid: silver.dedup_filtered(v)


def mart_plans(spark, sf, copies):
    stg = silver.staging(silver.valid(many(spark, sf, copies)))
    dense = materialized(stg)
    sparse = materialized(stg.withColumn("user_id", F.col("event_id")))
    for name, frame in (("few users", dense), ("a user per event", sparse)):
        yield f"hourly mart, {name}, exact distinct", lambda f=frame: marts.service_hourly_kpis(f)
        yield f"hourly mart, {name}, exact distinct apart", lambda f=frame: marts.service_hourly_kpis(f, apart=True)
        yield f"hourly mart, {name}, estimate", lambda f=frame: marts.service_hourly_kpis(f, exact_distinct=False)
        yield f"hourly mart, {name}, stored sketches", lambda f=frame: marts.service_hourly_sketches(f)
        yield f"error mart, {name}, exact distinct", lambda f=frame: marts.error_analytics(f)
        yield f"error mart, {name}, estimate", lambda f=frame: marts.error_analytics(f, exact_distinct=False)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("what", choices=["dedup", "marts"])
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=10)
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="pulsehouse-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.driver.memory": "8g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pulsehouse-measure-")})
    spark.sparkContext.setLogLevel("ERROR")
    found = []
    for name, plan in (dedup_plans if args.what == "dedup" else mart_plans)(spark, args.sf, args.copies):
        for again in (0, 1):
            spark.sparkContext.setJobGroup(f"{name} {again}", name)
            t = time.perf_counter()
            plan().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - t
        found.append((name, f"{name} 1", took))
    spark.stop()
    for name, group, took in found:
        mb, spill = shuffled(log_dir, group)
        print(f"{name}: {took:.1f} s, {mb:.1f} MB shuffled, {spill:.1f} MB spilled")


if __name__ == "__main__":
    main()

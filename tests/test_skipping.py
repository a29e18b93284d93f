"""Look-ups skip row groups by Bloom filters; running sums by blocks."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ev
from pulsehouse.functions.prefix import running_sum
from pulsehouse.operators import enrich, silver
from pulsehouse.plans.registry import materialized
from pulsehouse.schemas import BRONZE
from pulsehouse.session import scratch_path
from pulsehouse.sources import lake


def rows_read(df) -> int:
    """Rows the file scan gave to the plan, from its own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName().startswith("InputAdapter"):
            walk(node.child())
    walk(plan)
    assert found, plan.toString()
    return sum(found)


@pytest.fixture(scope="module")
def lookups(spark):
    n = 40_000
    base = spark.createDataFrame([ev("x")], BRONZE).drop("event_id", "user_id", "latency_ms")
    rows = spark.range(n).select(F.sha1(F.col("id").cast("string")).alias("event_id"),
                                 F.concat(F.lit("user_"), F.xxhash64("id") % 9_000).alias("user_id"),
                                 F.col("id").cast("int").alias("latency_ms")).crossJoin(base)
    sl = materialized(silver.valid(rows.select(*BRONZE.names)))
    path = scratch_path(spark, "t-skip")
    real, lake.LOOKUPS = lake.LOOKUPS, []
    lake.write_silver(sl, f"{path}/plain", max_records_per_file=2_000)
    lake.LOOKUPS = real
    lake.write_silver(sl, f"{path}/filtered", max_records_per_file=2_000)
    return path


def test_point_lookup_skips_row_groups(spark, lookups):
    wanted = spark.range(17, 18).select(F.sha1(F.col("id").cast("string"))).first()[0]

    def find(folder):
        return lake.read_silver(spark, f"{lookups}/{folder}").where(F.col("event_id") == wanted)
    assert [r.latency_ms for r in find("filtered").collect()] == [17]
    assert rows_read(find("plain")) >= 30_000          # hashes: no row group is skipped by min and max
    assert rows_read(find("filtered")) <= 8_000        # its own row group, and few by chance


def test_users_rows_are_together(spark, lookups):
    some = lake.read_silver(spark, f"{lookups}/filtered").groupBy("user_id").count().orderBy(F.desc("count")).first()
    found = lake.read_silver(spark, f"{lookups}/filtered").where(F.col("user_id") == some["user_id"])
    assert found.count() == some["count"] > 1
    assert rows_read(found) <= 12_000


def test_running_sum_in_blocks_equals_one_window(spark):
    day = dt.date(2024, 1, 1)
    rows = [(s, day + dt.timedelta(days=d), h, None if (d + h) % 7 == 0 else d * h) for s in ("a", None)
            for d in range(5) for h in range(0, 24, 5)] + [("b", day, 0, None)]
    df = spark.createDataFrame(rows, "service string, event_date date, event_hour int, total_requests bigint")
    got = running_sum(df, ["service"], F.col("event_date"), ["event_hour"], "total_requests", "c").collect()
    want, total = [], {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        total[r[0]] = total.get(r[0], 0) + (r[3] or 0)
        want.append((*r, total[r[0]]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_service_with_all_rows_is_many_tasks(spark):
    hours = spark.range(24 * 200).select(
        F.lit("hot").alias("service"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 24).cast("int")).alias("event_date"),
        (F.col("id") % 24).cast("int").alias("event_hour"), F.lit(1).cast("bigint").alias("total_requests"))
    out = enrich.cumulative_requests(materialized(hours))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 4800
    # rows are only ever dealt by (service, day); by service alone go the day sums
    dealt = [line for line in plan.splitlines() if "hashpartitioning(service" in line]
    assert any("_block" in line for line in dealt)
    assert out.agg(F.max("cumulative_requests")).first()[0] == 4800

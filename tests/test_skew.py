"""One key holding a third of the rows: results stay whole, work is split."""
import datetime as dt

from pyspark.sql import functions as F

from pulsehouse.operators import enrich, silver


def _skewed_stg(spark, n=30000):
    base = spark.range(n).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("user_hot"))
         .otherwise(F.concat(F.lit("user_"), (F.col("id") % 997).cast("string"))).alias("user_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(
            secs=(F.col("id") * 60).cast("decimal(18,6)"))).alias("event_ts"),
        (F.col("id") % 10 == 0).alias("is_error"))
    return base.withColumn("event_date", F.to_date("event_ts"))


def _history(spark):
    rows = [("user_hot", "free", dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 10)),
            ("user_hot", "premium", dt.datetime(2024, 1, 10), None)]
    rows += [(f"user_{i}", "free", dt.datetime(2023, 1, 1), None) for i in range(997)]
    return spark.createDataFrame(rows, "user_id string, plan string, dbt_valid_from timestamp_ntz, "
                                       "dbt_valid_to timestamp_ntz")


def test_point_in_time_join_splits_hot_key(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stg = _skewed_stg(spark).repartition(8)
        joined = enrich.point_in_time(stg, _history(spark), ["plan"])
        rows = joined.collect()
        # whole result: every event matched exactly one version, split at the change
        assert len(rows) == 30000 and all(r.plan is not None for r in rows)
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final, final[:2000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dedup_of_hot_event_id_is_whole(spark):
    # a third of all rows are copies of one event id
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("dup")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit("2024-01-01T00:00:00+00:00").alias("timestamp"), F.lit("auth-api").alias("service"),
        *[F.lit(None).cast(t).alias(c) for c, t in [
            ("endpoint", "string"), ("method", "string"), ("status_code", "int"),
            ("latency_ms", "int"), ("user_id", "string"), ("region", "string"), ("ip", "string"),
            ("error_message", "string")]])
    out = silver.transform(rows.repartition(8))
    assert out.count() == 20001


def test_day_grain_point_in_time_equals_event_grain(spark):
    """Versions changing mid-day, at midnight, twice a day, and a user with no
    history: the split plan must equal the plain event-grain join."""
    stg = _skewed_stg(spark, 6000)  # 6000 minutes from 2024-01-01 = ~4.2 days
    hist = spark.createDataFrame([
        ("user_hot", "free", dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 2, 13, 30)),
        ("user_hot", "premium", dt.datetime(2024, 1, 2, 13, 30), dt.datetime(2024, 1, 3)),
        ("user_hot", "enterprise", dt.datetime(2024, 1, 3), None),
        ("user_1", "free", dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 9)),
        ("user_1", "premium", dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 20)),
        ("user_1", "free", dt.datetime(2024, 1, 1, 20), None),
        ("user_2", "premium", dt.datetime(2023, 6, 1), None),
    ], "user_id string, plan string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    fast = enrich.kpis_point_in_time(stg, hist)
    brute = (enrich.point_in_time(stg, hist, ["plan"]).groupBy("event_date", "plan")
             .agg(F.count(F.lit(1)).alias("total_requests"),
                  F.sum(F.col("is_error").cast("int")).cast("bigint").alias("error_count")))
    def rows(df):
        return sorted(((r.event_date, r.plan or "", r.total_requests, r.error_count)
                       for r in df.collect()))
    a, b = rows(fast), rows(brute)
    assert a == b
    assert {p for _, p, _, _ in a} == {"", "free", "premium", "enterprise"}

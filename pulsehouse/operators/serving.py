"""Dashboard read queries over the marts.

V1-V4 roll the hourly / daily marts up as the dashboard does, including the
non-additive parts kept on purpose: the mean of hourly p95s (not a p95) and
sums of per-hour / per-service distinct counts (not distinct users).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (count_if_true, exact_percentiles, health_flag,
                                     hour_label, latency_percentiles, pct)


def service_health(kpis: DataFrame) -> DataFrame:
    req, err = F.sum("total_requests"), F.sum("error_count")
    return (kpis.groupBy("service")
            .agg(req.cast("bigint").alias("total_requests"),
                 err.cast("bigint").alias("total_errors"),
                 pct(err, req).alias("error_rate_pct"),
                 F.round(F.avg("p95_latency_ms"), 0).alias("avg_p95_latency_ms"),
                 F.sum("unique_users").cast("bigint").alias("user_events"))
            .orderBy(F.desc("error_rate_pct"), F.asc("service")))


def service_health_flagged(kpis: DataFrame, threshold: float = 10.0) -> DataFrame:
    """V1 plus the dashboard's high/ok flag as a column."""
    return service_health(kpis).withColumn("health", health_flag(F.col("error_rate_pct"), threshold))


def error_rate_trend(kpis: DataFrame, with_label: bool = True) -> DataFrame:
    req, err = F.sum("total_requests"), F.sum("error_count")
    out = (kpis.groupBy("event_date", "event_hour")
           .agg(req.cast("bigint").alias("total_requests"),
                pct(err, req).alias("error_rate_pct")))
    if with_label:
        out = out.withColumn("label", hour_label(F.col("event_date"), F.col("event_hour")))
    return out.orderBy("event_date", "event_hour")


def latency_summary(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("service")
            .agg(F.round(F.avg("p50_latency_ms"), 0).alias("p50"),
                 F.round(F.avg("p95_latency_ms"), 0).alias("p95"),
                 F.round(F.avg("p99_latency_ms"), 0).alias("p99"))
            .orderBy(F.desc("p95"), F.asc("service")))


def active_users_by_day(dau: DataFrame) -> DataFrame:
    return (dau.groupBy("event_date")
            .agg(F.sum("active_users").cast("bigint").alias("active_users"),
                 F.sum("total_requests").cast("bigint").alias("total_requests"))
            .orderBy("event_date"))


def p95_by_service(stg: DataFrame, accuracy: int | None = None) -> DataFrame:
    """True p95 per service straight from Silver.

    Default: exact nearest-rank p95 from a per-service latency histogram (the
    window runs over distinct latencies, not rows). ``accuracy`` switches to
    the one-pass sketch.
    """
    if accuracy:
        out = stg.groupBy("service").agg(
            *latency_percentiles(qs=(0.95,), names=("p95_latency_ms",), accuracy=accuracy),
            F.count(F.lit(1)).alias("total_requests"))
    else:
        out = exact_percentiles(stg, ["service"], "latency_ms", (0.95,), ("p95_latency_ms",),
                                total_name="total_requests")
    return (out.select("service", "p95_latency_ms", F.col("total_requests").cast("bigint"))
            .orderBy(F.desc("p95_latency_ms"), F.asc("service")))


def traffic_by_hour(stg: DataFrame) -> DataFrame:
    """Requests and error rate by hour of day across all days and services."""
    total, err = F.count(F.lit(1)), count_if_true(F.col("is_error"))
    return (stg.groupBy("event_hour")
            .agg(total.alias("total_requests"), err.alias("error_count"),
                 pct(err, total).alias("error_rate_pct"))
            .orderBy("event_hour"))


def error_breakdown(errors: DataFrame) -> DataFrame:
    """The error mart read back in its intended order (O1)."""
    return errors.orderBy(F.desc("error_count"), "service", "endpoint", "status_code")


def top_users(stg: DataFrame, k: int = 10) -> DataFrame:
    """Top-k users by request volume: partial counts, then TakeOrderedAndProject."""
    return (stg.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_requests"),
                 count_if_true(F.col("is_error")).alias("error_count"))
            .orderBy(F.desc("total_requests"), F.asc("user_id"))
            .limit(k))


def distinct_users_by_day(stg: DataFrame) -> DataFrame:
    """True daily active users (each user once per day across services), next
    to the dashboard's per-service sum. One aggregation; distinct handled by
    the two-phase (date, user) pre-aggregation."""
    return (stg.groupBy("event_date")
            .agg(F.countDistinct("user_id").alias("distinct_users"),
                 F.count(F.lit(1)).alias("total_requests"))
            .orderBy("event_date"))


def distinct_users_by_service(stg: DataFrame) -> DataFrame:
    """True distinct users per service over the whole period (the dashboard's
    ``user_events`` counts a user once per hour)."""
    return (stg.groupBy("service")
            .agg(F.countDistinct("user_id").alias("distinct_users"),
                 F.count(F.lit(1)).alias("total_requests"))
            .orderBy("service"))


# --- roll-ups that are true at any grain, from stored marts ------------------------

QUANTILES = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def latency_from_histogram(histogram: DataFrame, by: list[str], quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """Exact nearest-rank latency quantiles at any grain from the stored histogram; never reads Silver."""
    return exact_percentiles(histogram, by, "latency_ms", tuple(quantiles.values()), tuple(quantiles),
                             total_name="total_requests", weight="n").select(
        *by, *quantiles, F.col("total_requests").cast("bigint").alias("total_requests"))


def kpis_from_sketches(sketches: DataFrame, by: list[str], quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """KPIs at any grain from the stored sketches: exact counts, rates and mean; quantiles of the
    merged KLL sketch; distinct users of the merged HLL sketch (a user is counted once per group,
    however many hours or services they appear in)."""
    req, err = F.sum("total_requests"), F.sum("error_count")
    merged = sketches.groupBy(*by).agg(
        req.cast("bigint").alias("total_requests"), err.cast("bigint").alias("error_count"),
        F.sum("server_error_count").cast("bigint").alias("server_error_count"),
        pct(err, req).alias("error_rate_pct"),
        F.round(F.try_divide(F.sum("latency_sum_ms").cast("double"), F.sum("latency_count").cast("double")), 1)
        .alias("avg_latency_ms"),
        F.kll_merge_agg_bigint("latency_kll").alias("_kll"),
        F.sum("latency_count").alias("_n"),
        F.hll_union_agg("users_hll").alias("_hll"))
    picks = [F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_bigint("_kll", F.lit(q).cast("double"))).cast("int").alias(n)
             for n, q in quantiles.items()]
    return merged.select(*[c for c in merged.columns if c[0] != "_"], *picks,
                         F.hll_sketch_estimate("_hll").alias("unique_users"))


def users_from_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Distinct users per group from the stored sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("users_hll")).alias("unique_users"))

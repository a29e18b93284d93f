"""Stored sketches and histograms: true at any grain, in one shuffle, never from Silver."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ev
from pulsehouse.operators import marts, quality, serving, silver
from pulsehouse.plans import jobs, registry
from pulsehouse.schemas import BRONZE
from pulsehouse.session import scratch_path


def staged(spark, rows):
    return silver.staging(silver.transform(spark.createDataFrame(rows, BRONZE)))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


EDGE = [ev("a", latency=None, user=None), ev("b", "2026-06-17T13:00:00+00:00", latency=7, user="u1"),
        ev("c", "2026-06-17T13:10:00+00:00", latency=9, user="u1", status=500),
        ev("d", "2026-06-18T13:10:00+00:00", latency=5, user="u2", status=None),
        ev("e", "2026-06-18T14:10:00+00:00", service="user-svc", latency=None, user="u1")]


def test_histogram_quantiles_equal_the_ones_from_rows(spark):
    stg = registry.materialized(registry.stg_frame(spark, SF_SMALL))
    hist = registry.materialized(marts.latency_histogram(stg))
    got = serving.latency_from_histogram(hist, ["service"], {"p95_latency_ms": 0.95})
    assert rows_of(got) == rows_of(serving.p95_by_service(stg))
    hourly = serving.latency_from_histogram(hist, marts.KPI_KEYS)
    want = marts.service_hourly_kpis(stg, accuracy=None).select(*marts.KPI_KEYS, *marts.PCT_NAMES, "total_requests")
    assert rows_of(hourly) == rows_of(want)


def test_edge_groups(spark):
    stg = staged(spark, EDGE)
    hist = marts.latency_histogram(stg)
    by_day = {str(r[0]): tuple(r)[1:] for r in serving.latency_from_histogram(hist, ["event_date"]).collect()}
    assert by_day == {"2026-06-17": (7, 9, 9, 3), "2026-06-18": (5, 5, 5, 2)}
    sketches = registry.materialized(marts.service_hourly_sketches(stg))
    out = {str(r.event_date): r for r in serving.kpis_from_sketches(sketches, ["event_date"]).collect()}
    assert (out["2026-06-17"].total_requests, out["2026-06-17"].unique_users, out["2026-06-17"].avg_latency_ms) == (3, 1, 8.0)
    assert (out["2026-06-18"].unique_users, out["2026-06-18"].error_count) == (2, 0)
    # a group without a single latency or user
    hour = {r.event_hour: r for r in serving.kpis_from_sketches(sketches, ["event_hour"]).collect()}
    assert (hour[12].p95_latency_ms, hour[12].unique_users, hour[12].avg_latency_ms) == (None, 0, None)
    assert (hour[14].p50_latency_ms, hour[14].unique_users) == (None, 1)
    errs = marts.error_sketches(stg).collect()
    assert [(r.service, r.error_count) for r in errs] == [("auth-api", 1)]


def test_empty_input(spark):
    stg = staged(spark, [])
    assert serving.kpis_from_sketches(marts.service_hourly_sketches(stg), ["service"]).count() == 0
    assert serving.latency_from_histogram(marts.latency_histogram(stg), ["service"]).count() == 0


def test_merged_sketches_keep_their_error_bounds(spark):
    """Many hours with overlapping users and skewed latencies, merged once per service."""
    n = 100_000
    stg = spark.range(n).select(
        F.lit("s").alias("service"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("event_date"),
        (F.col("id") % 24).cast("int").alias("event_hour"), (F.col("id") % 7 == 0).alias("is_error"),
        F.lit(False).alias("is_server_error"), (F.pow(F.rand(3), F.lit(4.0)) * 60_000).cast("int").alias("latency_ms"),
        F.concat(F.lit("u"), (F.xxhash64("id") % 20_000)).alias("user_id"))
    stg = registry.materialized(stg)
    kpis = registry.materialized(serving.kpis_from_sketches(marts.service_hourly_sketches(stg), ["service"]))
    hist = marts.latency_histogram(stg)
    error = quality.quantile_rank_error(kpis, hist, ["service"], serving.QUANTILES).first()["rank_error"]
    assert error <= registry.RANK_BOUND
    exact = stg.groupBy("service").agg(F.countDistinct("user_id").alias("n"))
    assert quality.distinct_error(kpis, exact, ["service"], "unique_users", "n").first()["distinct_error"] <= registry.USERS_BOUND
    # the sum of hourly distinct users is far from it
    assert marts.service_hourly_kpis(stg).agg(F.sum("unique_users")).first()[0] > 2 * exact.first()["n"]


def test_error_measures_can_fail(spark):
    hist = spark.createDataFrame([("s", v, 1) for v in range(100)], "service string, latency_ms int, n bigint")
    est = spark.createDataFrame([("s", 80, 50)], "service string, p95 int, users int")
    assert quality.quantile_rank_error(est, hist, ["service"], {"p95": 0.95}).first()["rank_error"] == pytest.approx(0.14)
    exact = spark.createDataFrame([("s", 100)], "service string, n int")
    assert quality.distinct_error(est, exact, ["service"], "users", "n").first()["distinct_error"] == 0.5


def test_sketched_mart_is_one_shuffle(spark):
    stg = registry.materialized(registry.stg_frame(spark, SF_SMALL))
    plan = marts.service_hourly_sketches(stg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "partial_hll_sketch_agg" in plan
    assert marts.service_hourly_kpis(stg)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2


def test_rollups_are_read_without_silver(spark):
    root = scratch_path(spark, "t-rollups")
    from pulsehouse.sources import bronze as bronze_io
    bronze_io.land(spark.createDataFrame(EDGE, BRONZE), f"{root}/bronze", mode="overwrite")
    jobs.run_silver(spark, f"{root}/bronze", f"{root}/silver")
    jobs.build_gold(spark, f"{root}/silver", f"{root}/gold", run_checks=False)
    assert set(jobs.gold_paths(spark, f"{root}/gold")) == set(jobs.MARTS)
    jobs.build_gold(spark, f"{root}/silver", f"{root}/gold", run_checks=False, rollups=True)
    paths = jobs.gold_paths(spark, f"{root}/gold")
    hist = spark.read.parquet(paths["mart_latency_histogram"])
    files = hist.inputFiles()
    assert files and all("mart_latency_histogram" in f for f in files)
    assert serving.latency_from_histogram(hist, ["service"]).count() == 2


def test_users_counted_apart_give_the_same_marts(spark):
    stg = registry.materialized(staged(spark, [*EDGE, ev("f", user="u1", status=404), ev("g", endpoint=None, status=500, user=None)]))
    for accuracy in (10_000, None):
        assert rows_of(marts.service_hourly_kpis(stg, accuracy, apart=True)) == rows_of(marts.service_hourly_kpis(stg, accuracy))
        assert rows_of(marts.error_analytics(stg, accuracy, apart=True)) == rows_of(marts.error_analytics(stg, accuracy))
    assert marts.service_hourly_kpis(stg, apart=True).dtypes == marts.service_hourly_kpis(stg).dtypes

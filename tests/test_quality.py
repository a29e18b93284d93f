"""Data-quality checks return violating rows; gates stop the build."""
import pytest

from conftest import ev
from pulsehouse.operators import marts, quality, silver


def test_unique_and_not_null(spark, bronze_df):
    stg = bronze_df([ev("a"), ev("a"), ev("b", status=None)])
    dup = quality.unique(stg, "event_id").collect()
    assert [(r.event_id, r.n_records) for r in dup] == [("a", 2)]
    nn = {r.column_name: r.failures
          for r in quality.not_null_counts(stg, "m", ["event_id", "status_code"]).collect()}
    assert nn == {"event_id": 0, "status_code": 1}
    with pytest.raises(quality.DataQualityError):
        quality.assert_passes("unique", quality.unique(stg, "event_id"))
    with pytest.raises(quality.DataQualityError):
        quality.assert_passes("nn", quality.not_null_counts(stg, "m", ["status_code"]), "failures")


def test_error_rate_range_passes_on_real_mart(spark, bronze_df):
    stg = silver.staging(silver.transform(bronze_df([ev("a", status=500), ev("b")])))
    assert quality.error_rate_out_of_range(marts.service_hourly_kpis(stg)).count() == 0


def test_error_rate_range_catches_bad_rows(spark):
    df = spark.createDataFrame([("s", None, 1, 120.0), ("s", None, 2, -1.0), ("s", None, 3, None),
                                ("s", None, 4, 50.0)],
                               "service string, event_date date, event_hour int, error_rate_pct double")
    assert sorted(r.event_hour for r in quality.error_rate_out_of_range(df).collect()) == [1, 2]


def test_accepted_values_and_relationships(spark, bronze_df):
    stg = bronze_df([ev("a", method="PATCH"), ev("b", service="x-svc", user="user_9"), ev("c")])
    bad = {(r.column_name, r.value) for r in quality.accepted_values_suite(stg).collect()}
    assert bad == {("method", "PATCH"), ("service", "x-svc")}
    parent = spark.createDataFrame([("user_1",)], "user_id string")
    missing = quality.relationships(stg, parent, "user_id").collect()
    assert [(r.user_id, r.n_records) for r in missing] == [("user_9", 1)]


def test_freshness_status(spark, bronze_df):
    stg = silver.transform(bronze_df([ev("a", "2024-01-01T00:00:00+00:00")]))
    def status(as_of):
        return quality.freshness(stg, "event_ts", as_of).first().status
    assert status("2024-01-01 06:00:00") == "pass"
    assert status("2024-01-01 13:00:00") == "warn"
    assert status("2024-01-02 01:00:00") == "error"


def test_failing_check_stops_gold_build(spark, bronze_df):
    import os
    from pulsehouse.plans import jobs
    from pulsehouse.session import scratch_path
    from pulsehouse.sources import lake
    # two Silver rows share an event_id (written around the Silver job's dedup)
    rows = silver.derive(bronze_df([ev("a"), ev("a", latency=99), ev("b")]))
    root = scratch_path(spark, "t-gate")
    lake.write_silver(rows, f"{root}/silver")
    with pytest.raises(quality.DataQualityError):
        jobs.build_gold(spark, f"{root}/silver", f"{root}/gold")
    gold = f"{root}/gold"
    assert not os.path.exists(gold[len("file:"):] if gold.startswith("file:") else gold)


def test_freshness_of_empty_source_is_error(spark, bronze_df):
    empty = silver.transform(bronze_df([ev("a", "garbage")]))
    assert quality.freshness(empty, "event_ts", "2024-01-01 00:00:00").first().status == "error"

"""Data-quality checks (Q1-Q8). Each returns the violating rows; empty = pass.

``assert_passes`` turns a check into a gate that stops a build, as the
original build does on a failing test.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import METHODS, SERVICES


class DataQualityError(RuntimeError):
    pass


def unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (partial counts absorb hot keys)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def not_null_counts(df: DataFrame, model: str, cols: list[str]) -> DataFrame:
    """One scan, one row per column: (model, column_name, failures)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(model).alias("model"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (column_name, failures)"))


def not_null_marts(kpis: DataFrame, dau: DataFrame, errors: DataFrame) -> DataFrame:
    """The declared not_null tests of the three marts."""
    parts = [
        not_null_counts(kpis, "mart_service_hourly_kpis", ["service", "total_requests"]),
        not_null_counts(dau, "mart_daily_active_users", ["event_date", "active_users"]),
        not_null_counts(errors, "mart_error_analytics", ["service", "error_count"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def not_null_suite(stg: DataFrame, kpis: DataFrame, dau: DataFrame, errors: DataFrame) -> DataFrame:
    """All declared not_null tests, failures per (model, column)."""
    return not_null_counts(stg, "stg_events", ["event_id", "service", "status_code"]).unionByName(
        not_null_marts(kpis, dau, errors))


def error_rate_out_of_range(kpis: DataFrame) -> DataFrame:
    """Singular test: rates below 0 or above 100 (NULL passes)."""
    return (kpis.filter((F.col("error_rate_pct") < 0) | (F.col("error_rate_pct") > 100))
            .select("service", "event_date", "event_hour", "error_rate_pct"))


def accepted_values(df: DataFrame, allowed: dict[str, list]) -> DataFrame:
    """Values outside the allowed sets, with their counts (NULL is not tested).

    All columns are tested in one scan and one aggregation: each row yields
    its violating (column, value) pairs only.
    """
    bad = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                             (F.col(c).isNotNull() & ~F.col(c).isin(vals)).alias("bad"))
                    for c, vals in allowed.items()])
    pairs = df.select(F.explode(F.filter(bad, lambda x: x["bad"])).alias("v"))
    return pairs.groupBy("v.column_name", "v.value").agg(F.count(F.lit(1)).alias("n_records"))


def accepted_values_suite(stg: DataFrame, services=SERVICES, methods=METHODS) -> DataFrame:
    return accepted_values(stg, {"service": list(services), "method": list(methods)})


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys missing from the parent.

    The child is reduced to one row per key first (map-side partial counts),
    so the anti join moves distinct keys only and a hot key is one row.
    """
    keys = (child.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_records")))
    return keys.join(parent.select(key).distinct(), key, "left_anti")


def freshness(df: DataFrame, ts_col: str, as_of: str,
              warn_after_hours: float = 12, error_after_hours: float = 24) -> DataFrame:
    """Age of the newest record against ``as_of``: status pass / warn / error.
    A source with no records at all is reported as ``error``."""
    newest = df.agg(F.max(ts_col).cast("timestamp_ntz").alias("max_loaded_at"))
    as_of_col = F.lit(as_of).cast("timestamp_ntz")
    age = (F.unix_micros(as_of_col.cast("timestamp")) -
           F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3.6e9)
    return (newest.select("max_loaded_at", as_of_col.alias("snapshotted_at"),
                          F.round(age, 3).alias("age_hours"))
            .withColumn("status", F.when(F.col("age_hours").isNull(), "error")
                        .when(F.col("age_hours") > error_after_hours, "error")
                        .when(F.col("age_hours") > warn_after_hours, "warn").otherwise("pass")))


def staging_suite(stg: DataFrame, key: str = "event_id",
                  not_null: tuple = ("event_id", "service", "status_code")) -> dict:
    """unique(key) and not_null(cols) of the staging view in ONE scan.

    The not-null counts ride along as observed metrics of the scan that feeds
    the unique check's shuffle; the duplicate count is a global sum after it.
    Returns {"duplicate_keys": n, "not_null": {col: failures}}.
    """
    obs = Observation("staging_not_null")
    observed = stg.observe(obs, *[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    dup = unique(observed, key).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return {"duplicate_keys": dup, "not_null": dict(obs.get)}


def assert_staging(stg: DataFrame, **kw) -> None:
    res = staging_suite(stg, **kw)
    bad = {c: n for c, n in res["not_null"].items() if n}
    if res["duplicate_keys"] or bad:
        raise DataQualityError(f"staging checks failed: {res}")


def assert_passes(name: str, violations: DataFrame, failures_col: str | None = None) -> None:
    """Raise when a check finds anything. Reads at most one row (or one sum)."""
    if failures_col:
        total = violations.agg(F.sum(failures_col)).first()[0] or 0
        if total:
            raise DataQualityError(f"{name}: {total} failing records")
    elif violations.limit(1).count():
        raise DataQualityError(f"{name}: violations found")


# --- how far the stored sketches are off ------------------------------------------

def quantile_rank_error(estimates: DataFrame, histogram: DataFrame, by: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Per group, ``rank_error``: the largest distance of an estimated quantile's rank from the
    wanted one, as a share of the group's values, by the exact histogram (rows latency_ms, n).
    An estimate that ties with many values has all their ranks; the nearest counts."""
    h = histogram.where(F.col("latency_ms").isNotNull()).groupBy(*by, "latency_ms").agg(F.sum("n").alias("n"))
    e = estimates.select(*by, *quantiles)
    j = h.join(e, by)
    n = F.sum("n")
    distance = []
    for name, q in quantiles.items():
        below = F.coalesce(F.sum(F.when(F.col("latency_ms") < F.col(name), F.col("n"))), F.lit(0)) / n
        upto = F.coalesce(F.sum(F.when(F.col("latency_ms") <= F.col(name), F.col("n"))), F.lit(0)) / n
        distance.append(F.greatest(below - F.lit(q), F.lit(q) - upto, F.lit(0.0)))
    out = distance[0] if len(distance) == 1 else F.greatest(*distance)
    return j.groupBy(*by).agg(out.alias("rank_error"))


def distinct_error(estimates: DataFrame, exact: DataFrame, by: list[str], estimate: str, count: str) -> DataFrame:
    """Per group, ``distinct_error``: the estimate's relative distance from the exact count."""
    j = exact.select(*by, F.col(count).alias("_exact")).join(estimates.select(*by, F.col(estimate).alias("_est")), by)
    off = F.abs(F.col("_est") - F.col("_exact")) / F.greatest(F.col("_exact"), F.lit(1))
    return j.select(*by, off.alias("distinct_error"))

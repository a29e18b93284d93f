"""Gold marts over the staging view.

Each mart is one scan. With exact distinct users Spark aggregates in two
shuffles: the first on (group key, user_id), after map-side partial counts,
sums and latency sketches per (group, user), the second on the group key. A
hot service or hour is therefore spread over its users; a sketch per (group,
user) does travel through the first shuffle. ``apart=True`` counts the users in
an aggregation of their own, which moves (group, user) pairs and no sketches, and joins
it on the grain: about half the bytes and time where ``stg`` is a written table (it is
scanned twice). ``exact_distinct=False`` leaves one shuffle on the group key alone.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (PERCENTILE_ACCURACY, count_if_true, exact_percentiles,
                                     latency_percentiles, pct, ratio)

KPI_KEYS = ["service", "event_date", "event_hour"]
ERROR_KEYS = ["service", "endpoint", "status_code"]
# Sketch sizes. KLL: rank error about 1.33 / k^0.9 (0.4 % for one quantile at 600); HLL: 1.04 / sqrt(2^lgk).
KLL_K = 600
HLL_LGK = 13
PCT_NAMES = ("p50_latency_ms", "p95_latency_ms", "p99_latency_ms")


def _distinct_users(exact: bool):
    return F.countDistinct("user_id") if exact else F.approx_count_distinct("user_id")


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``left`` with ``values`` of ``right``, by null-safe equality of the keys."""
    r = right.select(*[F.col(k).alias("_x_" + k) for k in keys], *values)
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col("_x_" + k))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*["_x_" + k for k in keys])


def _with_users(agg: DataFrame, stg: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Join exact distinct users, counted apart, onto an aggregate."""
    users = (stg.filter(F.col("user_id").isNotNull()).select(*keys, "user_id").distinct()
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_users")))
    return _join_on(agg, users, keys, ["_users"]).withColumn(
        name, F.coalesce("_users", F.lit(0)).cast("bigint")).drop("_users")


def _with_exact(agg: DataFrame, stg: DataFrame, keys: list[str], qs, names,
                cols: list[str]) -> DataFrame:
    """Join exact histogram quantiles onto an aggregate by its (null-safe) keys."""
    ex = exact_percentiles(stg, keys, "latency_ms", qs, names)
    return _join_on(agg, ex, keys, list(names)).select(*cols)


def service_hourly_kpis(stg: DataFrame, accuracy: int | None = PERCENTILE_ACCURACY,
                        exact_distinct: bool = True, apart: bool = False) -> DataFrame:
    """Grain (service, event_date, event_hour).

    ``accuracy=None`` swaps the sketch for exact nearest-rank quantiles
    (histogram per group, joined back on the grain).
    """
    errors = count_if_true(F.col("is_error"))
    total = F.count(F.lit(1))
    cols = [*KPI_KEYS, "total_requests", "error_count", "server_error_count", "error_rate_pct",
            "avg_latency_ms", *PCT_NAMES, "unique_users"]
    sketches = latency_percentiles(accuracy=accuracy) if accuracy else []
    agg = (
        stg.groupBy(*KPI_KEYS)
        .agg(total.alias("total_requests"),
             errors.alias("error_count"),
             count_if_true(F.col("is_server_error")).alias("server_error_count"),
             pct(errors, total).alias("error_rate_pct"),
             F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
             *sketches,
             *([] if apart else [_distinct_users(exact_distinct).alias("unique_users")]))
    )
    if apart:
        agg = _with_users(agg, stg, KPI_KEYS, "unique_users")
    if accuracy:
        return agg.select(*cols)
    return _with_exact(agg, stg, KPI_KEYS, (0.5, 0.95, 0.99), PCT_NAMES, cols)


def daily_active_users(stg: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Grain (event_date, service). Without a sketch per user there is nothing to count apart."""
    users = _distinct_users(exact_distinct)
    total = F.count(F.lit(1))
    return (
        stg.groupBy("event_date", "service")
        .agg(users.alias("active_users"),
             total.alias("total_requests"),
             ratio(total, users, 1).alias("requests_per_user"))
    )


def error_analytics(stg: DataFrame, accuracy: int | None = PERCENTILE_ACCURACY,
                    exact_distinct: bool = True, apart: bool = False) -> DataFrame:
    """Grain (service, endpoint, status_code) over error rows only.

    ``where is_error`` drops false and NULL. The build order clause of the
    original model is not a table property; readers sort.
    """
    errs = stg.filter(F.col("is_error"))
    cols = [*ERROR_KEYS, "error_count", "affected_users", "p95_latency_ms"]
    sketch = (latency_percentiles(qs=(0.95,), names=("p95_latency_ms",), accuracy=accuracy)
              if accuracy else [])
    agg = (errs.groupBy(*ERROR_KEYS)
           .agg(F.count(F.lit(1)).alias("error_count"),
                *([] if apart else [_distinct_users(exact_distinct).alias("affected_users")]), *sketch))
    if apart:
        agg = _with_users(agg, errs, ERROR_KEYS, "affected_users")
    if accuracy:
        return agg.select(*cols)
    return _with_exact(agg, errs, ERROR_KEYS, (0.95,), ("p95_latency_ms",), cols)


# --- measures that stay true at any grain ------------------------------------

def _kll(col: str, k: int = KLL_K) -> Column:
    return F.kll_sketch_agg_bigint(F.col(col).cast("bigint"), k)


def _hll(col: str, lgk: int = HLL_LGK) -> Column:
    return F.hll_sketch_agg(F.col(col), F.lit(lgk))


def service_hourly_sketches(stg: DataFrame) -> DataFrame:
    """The hourly mart in a form that rolls up: counts, and mergeable sketches of latencies
    (KLL, ``latency_kll``) and users (HLL, ``users_hll``).

    One shuffle on the group key: a task sends one row per group with its sketches, of
    bounded size whatever the group's rows or users. Stored, they answer quantiles and distinct
    users per day, service, or anything above the hour, without the rows.
    """
    return (stg.groupBy(*KPI_KEYS)
            .agg(F.count(F.lit(1)).alias("total_requests"),
                 count_if_true(F.col("is_error")).alias("error_count"),
                 count_if_true(F.col("is_server_error")).alias("server_error_count"),
                 F.sum("latency_ms").cast("bigint").alias("latency_sum_ms"),
                 F.count("latency_ms").alias("latency_count"),
                 _kll("latency_ms").alias("latency_kll"),
                 _hll("user_id").alias("users_hll")))


def error_sketches(stg: DataFrame) -> DataFrame:
    """The error mart in that form (grain service, endpoint, status_code)."""
    return (stg.filter(F.col("is_error")).groupBy(*ERROR_KEYS)
            .agg(F.count(F.lit(1)).alias("error_count"),
                 _kll("latency_ms").alias("latency_kll"),
                 _hll("user_id").alias("users_hll")))


def latency_histogram(stg: DataFrame) -> DataFrame:
    """Requests per (service, event_date, event_hour, latency_ms): the exact form. Rows follow
    the distinct latencies of an hour, not its requests; sums of ``n`` give the histogram at
    any grain, and with it exact nearest-rank quantiles."""
    return stg.groupBy(*KPI_KEYS, "latency_ms").agg(F.count(F.lit(1)).alias("n"))

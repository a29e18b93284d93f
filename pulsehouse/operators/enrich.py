"""Joins and window analytics over Silver, marts and the users history
(J1-J3, J5 helpers, W1-W3).

Join sides are never broadcast on faith: the per-user sides are as large as
the user base, so these are shuffle joins that AQE turns into broadcast joins
only from measured runtime sizes, and splits when one key is hot.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import count_if_true, hour_start, pct
from ..functions.prefix import running_sum
from .asof import as_of_join


def kpis_by_dimension(stg: DataFrame, dim: DataFrame, attrs: list[str],
                      key: str = "user_id", how: str = "left") -> DataFrame:
    """Request KPIs by current-dimension attributes.

    Events are first reduced to one row per user (map-side partial counts), so
    the join moves one row per user however hot a user is, and distinct users
    per attribute become a plain count.
    """
    per_user = (stg.groupBy(key)
                .agg(F.count(F.lit(1)).alias("_n"),
                     count_if_true(F.col("is_error")).alias("_e")))
    joined = per_user.join(dim.select(key, *attrs), key, how)
    req, err = F.sum("_n"), F.sum("_e")
    return (joined.groupBy(*attrs)
            .agg(req.cast("bigint").alias("total_requests"),
                 err.cast("bigint").alias("error_count"),
                 pct(err, req).alias("error_rate_pct"),
                 F.count(F.col(key)).alias("unique_users")))


def point_in_time(stg: DataFrame, history: DataFrame, attrs: list[str],
                  key: str = "user_id", ts: str = "event_ts", how: str = "left") -> DataFrame:
    """Each event with the dimension version valid at its time.

    Equi-join on the key plus valid_from <= ts < valid_to (open end allowed).
    A key has one version per recorded change, so the key join is narrow; a
    hot key on the event side is split by AQE's skew-join handling. Each event of a key meets
    each of its versions: for keys with many versions use :func:`asof.as_of_join`.
    """
    h = history.select(F.col(key).alias("_k"), *attrs,
                       F.col("dbt_valid_from").alias("_from"), F.col("dbt_valid_to").alias("_to"))
    t = F.col(ts).cast("timestamp_ntz")
    cond = ((F.col(key) == F.col("_k")) & (t >= F.col("_from"))
            & (F.col("_to").isNull() | (t < F.col("_to"))))
    return stg.join(h, cond, how).drop("_k", "_from", "_to")


def kpis_point_in_time(stg: DataFrame, history: DataFrame, attr: str = "plan",
                       key: str = "user_id") -> DataFrame:
    """Daily requests by the attribute value that held when each event happened.

    Exact, and mostly at day grain: a (key, day) with no version boundary
    strictly inside the day has one version for all its events, so those
    events are first reduced to one row per (key, day) (partial aggregation,
    a hot key included), which takes the version valid as the day begins.
    Only events of (key, day) pairs where a version starts or ends mid-day
    are looked up one by one. Boundaries are rare (one per recorded change),
    so the event-grain path stays small.

    Both look-ups are merges (:func:`asof.as_of_join`), linear in rows plus versions also for
    a key with very many versions. How the list of cut days reaches the event-grain part
    is left to AQE: a small one is broadcast from its measured size, a large one is a
    shuffled semi join whose hot keys are split.
    """
    h = history.select(F.col(key).alias("_k"), F.col("dbt_valid_from").alias("_from"),
                       F.col("dbt_valid_to").alias("_to"))
    bounds = h.select("_k", F.col("_from").alias("_t")).unionByName(
        h.select("_k", F.col("_to").alias("_t")))
    cuts = (bounds.filter(F.col("_t").isNotNull() & (F.col("_t") != F.date_trunc("day", F.col("_t"))))
            .select(F.col("_k").alias("_ck"), F.to_date("_t").alias("_cd")).distinct())
    ev = stg.select(key, "event_ts", "event_date", "is_error")
    on_cut = (F.col(key) == F.col("_ck")) & (F.col("event_date") == F.col("_cd"))
    counts = [F.count(F.lit(1)).alias("_n"), count_if_true(F.col("is_error")).alias("_e")]

    daily = ev.groupBy(key, "event_date").agg(*counts).join(cuts, on_cut, "left_anti")
    by_day = as_of_join(daily.withColumn("_day", F.col("event_date").cast("timestamp_ntz")), history, [attr],
                        key=key, ts="_day", grain="month").select("event_date", attr, "_n", "_e")
    fine = as_of_join(ev.join(cuts, on_cut, "left_semi"), history, [attr], key=key)
    by_event = fine.groupBy("event_date", attr).agg(*counts)

    req, err = F.sum("_n"), F.sum("_e")
    return (by_day.unionByName(by_event).groupBy("event_date", attr)
            .agg(req.cast("bigint").alias("total_requests"), err.cast("bigint").alias("error_count"),
                 pct(err, req).alias("error_rate_pct")))


def hour_over_hour(kpis: DataFrame) -> DataFrame:
    """Self-join of the hourly mart: each hour vs the previous hour."""
    k = kpis.select("service", "event_date", "event_hour", "total_requests", "error_rate_pct",
                    hour_start(F.col("event_date"), F.col("event_hour")).alias("_h"))
    prev = k.select("service", (F.col("_h") + F.expr("INTERVAL 1 HOUR")).alias("_h"),
                    F.col("total_requests").alias("prev_total_requests"),
                    F.col("error_rate_pct").alias("prev_error_rate_pct"))
    return (k.join(prev, ["service", "_h"], "left")
            .select("service", "event_date", "event_hour", "total_requests",
                    "prev_total_requests",
                    (F.col("total_requests") - F.col("prev_total_requests")).alias("delta_requests"),
                    "error_rate_pct", "prev_error_rate_pct"))


def busiest_hours(kpis: DataFrame, k: int = 3) -> DataFrame:
    """Top-k hours per service by volume (ROW_NUMBER, ties broken by time).

    One task per service, over that service's hours (8,784 a year), not its events."""
    w = Window.partitionBy("service").orderBy(F.desc("total_requests"), "event_date", "event_hour")
    return (kpis.select("service", "event_date", "event_hour", "total_requests")
            .withColumn("hour_rank", F.row_number().over(w))
            .filter(F.col("hour_rank") <= k))


def service_rank_hourly(kpis: DataFrame) -> DataFrame:
    """Services ranked by error rate within each hour (RANK and DENSE_RANK)."""
    w = Window.partitionBy("event_date", "event_hour").orderBy(F.desc("error_rate_pct"))
    return (kpis.select("event_date", "event_hour", "service", "error_rate_pct")
            .withColumn("error_rank", F.rank().over(w))
            .withColumn("error_dense_rank", F.dense_rank().over(w)))


def cumulative_requests(kpis: DataFrame) -> DataFrame:
    """Running total of requests per service over time (SUM OVER), in two levels: days first,
    then the hours inside a day, so a task holds a day of a service and no service is one task."""
    return running_sum(kpis.select("service", "event_date", "event_hour", "total_requests"), ["service"],
                       F.col("event_date"), ["event_hour"], "total_requests", "cumulative_requests")

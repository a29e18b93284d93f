"""Named queries over a test-data folder: (spark, sf_dir) -> DataFrame.

Every query starts from the given parquet tables (through the bridge) and
runs the library's operators over whole tables. Timestamps leave as
``timestamp_ntz`` so they compare with the SQL oracle's naive timestamps.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import hour_label
from ..operators import asof, enrich, marts, quality, scd2, serving, serving_sql, silver
from ..schemas import METHODS, SERVICES, SILVER_COLUMNS
from ..session import prepare, scratch_path
from ..sources import bridge, lake
from ..sources import bronze as bronze_io
from ..streaming import live
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Cast instant columns to wall-clock UTC (the session is pinned to UTC)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# --- shared frames ---------------------------------------------------------

def materialized(df: DataFrame) -> DataFrame:
    """A frame used by several branches of one query is written once as Parquet
    below the checkpoint root and read back, so branches still prune columns
    and push filters down, and the lineage is cut."""
    path = scratch_path(df.sparkSession, "shared")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transform(bridge.bronze(spark, sf_dir, dirty=True))


def stg_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.staging(silver_frame(spark, sf_dir))


def kpis_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.service_hourly_kpis(stg_frame(spark, sf_dir))


def dau_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_active_users(stg_frame(spark, sf_dir))


def errors_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.error_analytics(stg_frame(spark, sf_dir))


# --- Silver / staging --------------------------------------------------------

@register("silver_transform")
def q_silver_transform(spark, sf_dir):
    """P1-P8 + D1 over the dirty Bronze bridge."""
    return ntz(silver_frame(spark, sf_dir), "event_ts")


@register("stg_events")
def q_stg_events(spark, sf_dir):
    return ntz(stg_frame(spark, sf_dir), "event_ts")


# --- marts -------------------------------------------------------------------

@register("mart_service_hourly_kpis")
def q_kpis(spark, sf_dir):
    return kpis_frame(spark, sf_dir)


@register("mart_daily_active_users")
def q_dau(spark, sf_dir):
    return dau_frame(spark, sf_dir)


@register("mart_error_analytics")
def q_errors(spark, sf_dir):
    return serving.error_breakdown(errors_frame(spark, sf_dir))


# --- serving -----------------------------------------------------------------

@register("service_health")
def q_service_health(spark, sf_dir):
    return serving.service_health(kpis_frame(spark, sf_dir))


@register("error_rate_trend")
def q_error_rate_trend(spark, sf_dir):
    return serving.error_rate_trend(kpis_frame(spark, sf_dir))


@register("latency_percentiles")
def q_latency(spark, sf_dir):
    return serving.latency_summary(kpis_frame(spark, sf_dir))


@register("daily_active_users")
def q_daily_active_users(spark, sf_dir):
    return serving.active_users_by_day(dau_frame(spark, sf_dir))


# --- row-level operators -----------------------------------------------------

@register("hour_label")
def q_hour_label(spark, sf_dir):
    """The dashboard's 'YYYY-MM-DD HH:00' bucket label."""
    k = kpis_frame(spark, sf_dir)
    return k.select("service", "event_date", "event_hour",
                    hour_label(F.col("event_date"), F.col("event_hour")).alias("label"))


@register("service_health_flag")
def q_service_health_flag(spark, sf_dir):
    """V1 with the high/ok flag the dashboard computes client-side."""
    return serving.service_health_flagged(kpis_frame(spark, sf_dir))


@register("quarantine")
def q_quarantine(spark, sf_dir):
    """Rejected Bronze rows with the first failed gate."""
    return silver.quarantine(bridge.bronze(spark, sf_dir, dirty=True))


CUT_MOD, CUT_CHARS = 83, 30       # these ids' landed lines are cut after so many characters


@register("quarantine_raw")
def q_quarantine_raw(spark, sf_dir):
    """S1 + P14: landed files with broken lines; the job's rejects keep the text of each."""
    root = scratch_path(spark, "lake")
    rows = bridge.bronze(spark, sf_dir, dirty=True)
    cut = F.substring("event_id", 4, 20).cast("bigint") % CUT_MOD == 0
    line = F.when(cut, F.substring(bronze_io.body(), 1, CUT_CHARS)).otherwise(bronze_io.body())
    bronze_io.land(rows, f"{root}/bronze", mode="overwrite", line=line)
    jobs.run_silver(spark, f"{root}/bronze", f"{root}/silver", quarantine_path=f"{root}/rejects", dedup="filter")
    return spark.read.schema(jobs.PARSED).parquet(f"{root}/rejects")


@register("silver_counts")
def q_silver_counts(spark, sf_dir):
    """Raw and cleaned counts in one pass."""
    return silver.stage_counts(bridge.bronze(spark, sf_dir, dirty=True))


@register("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    """D1 with a repeatable survivor (smallest row per event_id)."""
    b = silver.derive(bridge.bronze(spark, sf_dir, dirty=True)).filter(silver.gate_condition())
    return ntz(silver.dedup(b, deterministic=True), "event_ts")


@register("silver_dedup_filtered")
def q_silver_dedup_filtered(spark, sf_dir):
    """D1 with a filter of repeated keys: only rows that may have a twin are shuffled by event_id."""
    b = silver.derive(bridge.bronze(spark, sf_dir, dirty=True)).filter(silver.gate_condition())
    return ntz(silver.dedup_filtered(materialized(b)), "event_ts")


# --- ad-hoc analytics ----------------------------------------------------------

@register("p95_by_service")
def q_p95_by_service(spark, sf_dir):
    return serving.p95_by_service(stg_frame(spark, sf_dir))


@register("traffic_by_hour")
def q_traffic_by_hour(spark, sf_dir):
    return serving.traffic_by_hour(stg_frame(spark, sf_dir))


@register("top_users")
def q_top_users(spark, sf_dir):
    return serving.top_users(stg_frame(spark, sf_dir), k=10)


# --- data quality ----------------------------------------------------------------

@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    """Q1 on the gated rows before dedup, where keys do repeat."""
    return quality.unique(silver.valid(bridge.bronze(spark, sf_dir, dirty=True)), "event_id")


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    stg = materialized(stg_frame(spark, sf_dir))
    return quality.not_null_suite(stg, marts.service_hourly_kpis(stg),
                                  marts.daily_active_users(stg), marts.error_analytics(stg))


@register("dq_error_rate_range")
def q_dq_error_rate_range(spark, sf_dir):
    """Q6 on rates with a declared fault: every error counted twice."""
    kpis = kpis_frame(spark, sf_dir).withColumn("error_rate_pct", F.col("error_rate_pct") * 2)
    return quality.error_rate_out_of_range(kpis)


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    """Q7 with declared lists that leave out one service and one method."""
    return quality.accepted_values_suite(stg_frame(spark, sf_dir), SERVICES[:-1], METHODS[:-1])


@register("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    return quality.relationships(stg_frame(spark, sf_dir),
                                 scd2.current(users_history(spark, sf_dir)), "user_id")


@register("dq_freshness")
def q_dq_freshness(spark, sf_dir):
    return quality.freshness(silver_frame(spark, sf_dir), "event_ts", FRESHNESS_AS_OF)


# --- users dimension (type-2 snapshot) ------------------------------------------

CHECK_COLS = ["plan", "country"]
FRESHNESS_AS_OF = "2024-01-31 00:00:00"


def users_history(spark: SparkSession, sf_dir: str, second_at: str = bridge.SNAPSHOT_2_AT) -> DataFrame:
    s1, s2 = bridge.users_snapshots(spark, sf_dir)
    v1 = scd2.snapshot_check(None, s1, "user_id", CHECK_COLS, bridge.SNAPSHOT_1_AT)
    return scd2.snapshot_check(v1, s2, "user_id", CHECK_COLS, second_at)


@register("users_scd2_rejects")
def q_users_scd2_rejects(spark, sf_dir):
    """X1/X2 guard: source rows whose key is NULL or repeats."""
    return scd2.reject_keys(bridge.users_with_faulty_keys(spark, sf_dir), "user_id")


@register("users_snapshot_sink")
def q_users_snapshot_sink(spark, sf_dir):
    """Two runs into the stored snapshot, the history read through its pointer."""
    base = scratch_path(spark, "users-snapshot")
    s1, s2 = bridge.users_snapshots(spark, sf_dir)
    scd2.run_snapshot(spark, base, s1, "user_id", CHECK_COLS, bridge.SNAPSHOT_1_AT)
    return scd2.run_snapshot(spark, base, s2, "user_id", CHECK_COLS, bridge.SNAPSHOT_2_AT)


@register("users_scd2_initial")
def q_users_scd2_initial(spark, sf_dir):
    s1, _ = bridge.users_snapshots(spark, sf_dir)
    return scd2.snapshot_check(None, s1, "user_id", CHECK_COLS, bridge.SNAPSHOT_1_AT)


@register("users_scd2")
def q_users_scd2(spark, sf_dir):
    return users_history(spark, sf_dir)


@register("users_current")
def q_users_current(spark, sf_dir):
    return scd2.current(users_history(spark, sf_dir))


@register("users_scd2_ts")
def q_users_scd2_ts(spark, sf_dir):
    s1, s2 = bridge.users_snapshots(spark, sf_dir, with_updated_at=True)
    v1 = scd2.snapshot_timestamp(None, s1, "user_id")
    return scd2.snapshot_timestamp(v1, s2, "user_id")


# --- joins and windows -----------------------------------------------------------

@register("kpis_by_plan")
def q_kpis_by_plan(spark, sf_dir):
    """Request KPIs by the user's current plan (unmatched users -> NULL plan)."""
    return enrich.kpis_by_dimension(stg_frame(spark, sf_dir),
                                    scd2.current(users_history(spark, sf_dir)), ["plan"])


@register("kpis_by_plan_inner")
def q_kpis_by_plan_inner(spark, sf_dir):
    return enrich.kpis_by_dimension(stg_frame(spark, sf_dir),
                                    scd2.current(users_history(spark, sf_dir)), ["plan"],
                                    how="inner")


@register("kpis_by_country")
def q_kpis_by_country(spark, sf_dir):
    return enrich.kpis_by_dimension(stg_frame(spark, sf_dir),
                                    scd2.current(users_history(spark, sf_dir)), ["country"])


@register("events_asof_plan")
def q_events_asof_plan(spark, sf_dir):
    """Daily requests by the plan valid at event time. The second snapshot is taken at
    mid-day, so days with a change take the event-grain branch, the others the day-grain one."""
    return enrich.kpis_point_in_time(
        materialized(stg_frame(spark, sf_dir)),
        materialized(users_history(spark, sf_dir, bridge.SNAPSHOT_MIDDAY_AT)))


@register("events_with_plan")
def q_events_with_plan(spark, sf_dir):
    """J2 at event grain by the merge: every event with the plan and country valid at its time."""
    history = materialized(users_history(spark, sf_dir, bridge.SNAPSHOT_MIDDAY_AT))
    ev = materialized(stg_frame(spark, sf_dir)).select("event_id", "event_ts", "user_id", "service")
    return ntz(asof.as_of_join(ev, history, ["plan", "country"]), "event_ts")


@register("hour_over_hour_self")
def q_hour_over_hour(spark, sf_dir):
    """The mart is used on both sides, so it is materialized once."""
    return enrich.hour_over_hour(materialized(kpis_frame(spark, sf_dir)))


@register("busiest_hours")
def q_busiest_hours(spark, sf_dir):
    return enrich.busiest_hours(kpis_frame(spark, sf_dir), k=3)


@register("service_rank_hourly")
def q_service_rank_hourly(spark, sf_dir):
    return enrich.service_rank_hourly(kpis_frame(spark, sf_dir))


@register("cumulative_requests")
def q_cumulative_requests(spark, sf_dir):
    return enrich.cumulative_requests(kpis_frame(spark, sf_dir))


# --- sources and sinks (each writes below the checkpoint root, then reads back) ----

BACKFILL_END, BACKFILL_HOURS = "2024-01-30 23:30:00", 72


@register("bronze_land")
def q_bronze_land(spark, sf_dir):
    """Landed JSON files per service/year/month/day/hour folder."""
    path = scratch_path(spark, "bronze")
    bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True), path, mode="overwrite")
    return (bronze_io.scan_layout(spark, path).groupBy(*bronze_io.LAYOUT)
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("bronze_scan")
def q_bronze_scan(spark, sf_dir):
    """Recursive JSON scan with the fixed schema; body wins over folders."""
    path = scratch_path(spark, "bronze")
    bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True), path, mode="overwrite")
    return bronze_io.scan(spark, path)


@register("bronze_backfill")
def q_bronze_backfill(spark, sf_dir):
    """The last 72 hour windows landed in one job."""
    path = scratch_path(spark, "bronze")
    bronze_io.backfill(bridge.bronze(spark, sf_dir, dirty=True), path,
                       BACKFILL_END, BACKFILL_HOURS)
    return (bronze_io.scan_layout(spark, path).groupBy(*bronze_io.LAYOUT)
            .agg(F.count(F.lit(1)).alias("n_events")))


def _landed_silver(spark, sf_dir):
    root = scratch_path(spark, "lake")
    bronze_path, silver_path = f"{root}/bronze", f"{root}/silver"
    bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True), bronze_path, mode="overwrite")
    counts = jobs.run_silver(spark, bronze_path, silver_path)
    return root, silver_path, counts


@register("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    """E1 + S4 + S2: Bronze files -> Silver job -> partitioned Parquet -> read."""
    _, silver_path, _ = _landed_silver(spark, sf_dir)
    return ntz(lake.read_silver(spark, silver_path), "event_ts").select(*SILVER_COLUMNS)


@register("silver_job_counts")
def q_silver_job_counts(spark, sf_dir):
    """The Silver job's own counts (with the quarantine sink, so one JSON parse)."""
    root = scratch_path(spark, "lake")
    bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True), f"{root}/bronze", mode="overwrite")
    counts = jobs.run_silver(spark, f"{root}/bronze", f"{root}/silver", quarantine_path=f"{root}/rejects")
    rejects = spark.read.parquet(f"{root}/rejects").agg(F.count(F.lit(1)).alias("reject_count"))
    return rejects.select(F.lit(counts["raw_count"]).cast("bigint").alias("raw_count"),
                          F.lit(counts["clean_count"]).cast("bigint").alias("clean_count"), "reject_count")


@register("catalog_silver")
def q_catalog_silver(spark, sf_dir):
    """S12 + S13: register Silver with its partitions, then plain SQL on it."""
    _, silver_path, _ = _landed_silver(spark, sf_dir)
    table = lake.register_partitioned(spark, silver_path)
    return spark.sql(f"""
        SELECT event_date, service, count(*) AS n_events,
               sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS error_count
        FROM `{table}` GROUP BY event_date, service""")


@register("users_seed")
def q_users_seed(spark, sf_dir):
    """S3: the users dimension as header CSV, read back with declared types."""
    _, s2 = bridge.users_snapshots(spark, sf_dir)
    path = scratch_path(spark, "seed_users")
    lake.write_seed(s2, path)
    return lake.read_seed(spark, path)


def _gold(spark, sf_dir, name):
    root, silver_path, _ = _landed_silver(spark, sf_dir)
    jobs.build_gold(spark, silver_path, f"{root}/gold")
    return spark.read.parquet(jobs.gold_paths(spark, f"{root}/gold")[name])


@register("gold_build")
def q_gold_build(spark, sf_dir):
    """Staging -> marts -> checks -> switch, on written tables; the hourly mart."""
    return _gold(spark, sf_dir, "mart_service_hourly_kpis")


def _rollups(spark, sf_dir):
    """The published roll-up marts of a Gold build, as name -> frame."""
    root, silver_path, _ = _landed_silver(spark, sf_dir)
    jobs.build_gold(spark, silver_path, f"{root}/gold", rollups=True)
    return {n: spark.read.parquet(p) for n, p in jobs.gold_paths(spark, f"{root}/gold").items()}


@register("p95_from_marts")
def q_p95_from_marts(spark, sf_dir):
    """V5 + A7 from the stored latency histogram alone: the true p95 per service."""
    hist = _rollups(spark, sf_dir)["mart_latency_histogram"]
    return serving.latency_from_histogram(hist, ["service"], {"p95_latency_ms": 0.95})


@register("latency_by_day_from_marts")
def q_latency_by_day_from_marts(spark, sf_dir):
    """A6-A8 at day grain from the stored histogram: true quantiles, not means of hourly ones."""
    return serving.latency_from_histogram(_rollups(spark, sf_dir)["mart_latency_histogram"], ["event_date"])


# Bounds that the sketch rows are held to: three times the sketches' own 99 % / one-sigma errors.
RANK_BOUND, USERS_BOUND = 0.014, 0.035


def _sketched(spark, sf_dir, by):
    """KPIs from stored sketches: exact measures, and whether the estimates are within their bounds."""
    gold = _rollups(spark, sf_dir)
    kpis = materialized(serving.kpis_from_sketches(gold["mart_service_hourly_sketches"], by))
    exact = stg_frame(spark, sf_dir).groupBy(*by).agg(F.countDistinct("user_id").alias("exact_users"))
    ranks = quality.quantile_rank_error(kpis, gold["mart_latency_histogram"], by, serving.QUANTILES)
    users = quality.distinct_error(kpis, exact, by, "unique_users", "exact_users")
    return kpis.join(ranks, by, "left").join(users, by, "left").select(
        *by, "total_requests", "error_count", "server_error_count", "error_rate_pct", "avg_latency_ms",
        (F.col("rank_error") <= RANK_BOUND).alias("quantiles_within_bound"),
        (F.col("distinct_error") <= USERS_BOUND).alias("users_within_bound"))


@register("sketch_kpis_by_service")
def q_sketch_kpis_by_service(spark, sf_dir):
    """Hourly sketches merged per service over the whole period."""
    return _sketched(spark, sf_dir, ["service"])


@register("sketch_kpis_by_day")
def q_sketch_kpis_by_day(spark, sf_dir):
    """Hourly sketches merged per day across services (a user counts once a day)."""
    return _sketched(spark, sf_dir, ["event_date"])


@register("sketch_affected_users")
def q_sketch_affected_users(spark, sf_dir):
    """Users affected by errors per service, from the error mart's stored sketches."""
    errs = _rollups(spark, sf_dir)["mart_error_sketches"]
    est = errs.groupBy("service").agg(F.sum("error_count").cast("bigint").alias("error_count"),
                                      F.hll_sketch_estimate(F.hll_union_agg("users_hll")).alias("affected_users"))
    exact = stg_frame(spark, sf_dir).where("is_error").groupBy("service").agg(
        F.countDistinct("user_id").alias("exact_users"))
    off = quality.distinct_error(est, exact, ["service"], "affected_users", "exact_users")
    return est.join(off, "service", "left").select(
        "service", "error_count", (F.col("distinct_error") <= USERS_BOUND).alias("users_within_bound"))


@register("gold_build_active_users")
def q_gold_build_active_users(spark, sf_dir):
    return _gold(spark, sf_dir, "mart_daily_active_users")


@register("gold_build_errors")
def q_gold_build_errors(spark, sf_dir):
    return _gold(spark, sf_dir, "mart_error_analytics")


@register("gold_build_snapshot")
def q_gold_build_snapshot(spark, sf_dir):
    """E2 with its seed and snapshot steps, twice: the users history through the pointer."""
    root, silver_path, _ = _landed_silver(spark, sf_dir)
    for users, at in zip(bridge.users_snapshots(spark, sf_dir), (bridge.SNAPSHOT_1_AT, bridge.SNAPSHOT_2_AT)):
        jobs.build_gold(spark, silver_path, f"{root}/gold", users=users, run_ts=at)
    return scd2.read_history(spark, f"{root}/gold/users_snapshot")


@register("end_to_end_rerun")
def q_end_to_end_rerun(spark, sf_dir):
    """E3 twice into the same folders (Bronze appended twice): same answer."""
    root = scratch_path(spark, "lake")
    rows = bridge.bronze(spark, sf_dir, dirty=True)
    for users, at in zip(bridge.users_snapshots(spark, sf_dir), (bridge.SNAPSHOT_1_AT, bridge.SNAPSHOT_2_AT)):
        jobs.run_all(spark, rows, root, land_mode="append", users=users, run_ts=at)
    return jobs.serving_results(spark, f"{root}/gold")["service-health"]


def _exported(spark, sf_dir):
    root, silver_path, _ = _landed_silver(spark, sf_dir)
    jobs.build_gold(spark, silver_path, f"{root}/gold", run_checks=False)
    return jobs.export_snapshot(spark, f"{root}/gold", f"{root}/export", EXPORT_AT)


EXPORT_AT = "2024-01-31 05:30:00+05:30"      # the run time the export is given
# Schemas of the exported JSON.
EXPORTS = {
    "error_trend": ("error-trend", "event_date date, event_hour int, total_requests bigint, "
                                   "error_rate_pct double, label string"),
    "service_health": ("service-health", "service string, total_requests bigint, total_errors bigint, "
                                         "error_rate_pct double, avg_p95_latency_ms double, user_events bigint"),
    "latency": ("latency", "service string, p50 double, p95 double, p99 double"),
    "active_users": ("active-users", "event_date date, active_users bigint, total_requests bigint"),
}


def _export_query(name):
    def run(spark, sf_dir):
        folder, schema = EXPORTS[name]
        return spark.read.schema(schema).json(_exported(spark, sf_dir)[folder])
    run.__name__ = f"q_export_{name}"
    return run


for _name in EXPORTS:
    register(f"export_{_name}")(_export_query(_name))


@register("export_meta")
def q_export_meta(spark, sf_dir):
    """The export's time stamp, the run time it was given, in UTC."""
    return spark.read.schema("generated_at string").json(_exported(spark, sf_dir)["meta"])


# --- streaming (the stream runs to completion with an available-now trigger) ---

def _streamed(spark, sf_dir, *kinds: str) -> list[DataFrame]:
    root = scratch_path(spark, "stream")
    bronze_path = f"{root}/bronze"
    bronze_io.land(bridge.bronze(spark, sf_dir, dirty=True), bronze_path, mode="overwrite")
    slv = live.silver_stream(live.bronze_stream(spark, bronze_path))
    out = []
    for kind in kinds:
        if kind == "silver":
            live.start_silver_sink(slv, f"{root}/silver", f"{root}/_ck_silver").awaitTermination()
            out.append(live.read_silver_sink(spark, f"{root}/silver"))
        elif kind == "users":
            live.start_users_sink(live.distinct_users_stream(slv), f"{root}/users", f"{root}/_ck_users").awaitTermination()
            out.append(live.read_users_sink(spark, f"{root}/users"))
        else:
            live.start_kpis_sink(live.hourly_kpis_stream(slv), f"{root}/kpis", f"{root}/_ck_kpis").awaitTermination()
            out.append(live.read_kpis_sink(spark, f"{root}/kpis"))
    return out


@register("stream_silver")
def q_stream_silver(spark, sf_dir):
    """Streaming Silver equals batch Silver when nothing is late."""
    return ntz(_streamed(spark, sf_dir, "silver")[0], "event_ts")


@register("stream_hourly_kpis")
def q_stream_hourly_kpis(spark, sf_dir):
    """Streaming hourly KPIs, with distinct users counted from the streaming Silver."""
    slv, kpis = _streamed(spark, sf_dir, "silver", "kpis")
    return kpis.drop("approx_unique_users").join(live.exact_hourly_users(slv), live.KPI_KEYS).select(
        *STREAM_EXACT_COLS, "unique_users")


@register("stream_distinct_users")
def q_stream_distinct_users(spark, sf_dir):
    """T5: exact distinct users per service and closed hour, counted in the stream (three stateful
    stages, no read of the Silver sink)."""
    return _streamed(spark, sf_dir, "users")[0]


STREAM_EXACT_COLS = ["service", "event_date", "event_hour", "total_requests", "error_count",
                     "server_error_count", "error_rate_pct", "avg_latency_ms",
                     "p50_latency_ms", "p95_latency_ms", "p99_latency_ms"]


@register("stream_hourly_volume")
def q_stream_hourly_volume(spark, sf_dir):
    """T4: the streaming hourly KPIs' exact measures (all but approximate users)."""
    return _streamed(spark, sf_dir, "kpis")[0].select(*STREAM_EXACT_COLS)


# --- SQL text over the marts (S13) -----------------------------------------------

def _sql_query(name):
    def run(spark, sf_dir):
        stg = stg_frame(spark, sf_dir)
        frames = {"kpis": marts.service_hourly_kpis, "dau": marts.daily_active_users, "errors": marts.error_analytics}
        used = {k: f(stg) for k, f in frames.items() if "{" + k + "}" in serving_sql.STATEMENTS[name]}
        return serving_sql.run(spark, serving_sql.STATEMENTS[name], **used)
    run.__name__ = f"q_sql_{name}"
    return run


for _name in serving_sql.STATEMENTS:
    register(f"sql_{_name}")(_sql_query(_name))


@register("distinct_users_by_day")
def q_distinct_users_by_day(spark, sf_dir):
    """True daily distinct users (A22's additive sum kept in daily_active_users)."""
    return serving.distinct_users_by_day(stg_frame(spark, sf_dir))


@register("distinct_users_by_service")
def q_distinct_users_by_service(spark, sf_dir):
    """True distinct users per service (A18's per-hour sum kept in service_health)."""
    return serving.distinct_users_by_service(stg_frame(spark, sf_dir))

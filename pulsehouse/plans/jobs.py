"""End-to-end jobs (E1-E4): plain function calls in dependency order.

Every stage reads the previous stage's *written* table, so lineage is cut at
each layer: a lost executor re-runs tasks of the current layer only. Silver and
marts go to new versions that a pointer names when they are whole, so a rerun after
a failure gives the same result (dedup makes Silver idempotent in its input too).
"""
from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import marts, quality, scd2, serving, silver
from ..schemas import BRONZE, RAW_LINE, SILVER_COLUMNS
from ..session import conf_during, scratch_path
from ..sources import bronze as bronze_io
from ..sources import lake


PARSED = StructType([*BRONZE.fields, StructField(RAW_LINE, StringType(), True),
                     StructField("reject_reason", StringType(), True)])
DEDUPS = ("aggregate", "filter")


class EmptySilverError(RuntimeError):
    """A run without a single valid row would have replaced a Silver that has rows."""


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str,
               deterministic: bool = True, quarantine_path: str | None = None,
               allow_empty: bool = False, dedup: str = "aggregate") -> dict:
    """Bronze JSON -> Silver Parquet; returns raw and clean counts.

    Dedup keeps the smallest twin by (event_ts, other columns) by default, so
    a rerun — or a stage recomputed after an executor loss — writes the same
    Silver even when twins differ; ``deterministic=False`` keeps any twin.
    ``dedup="filter"`` moves only rows whose key may repeat (see :func:`silver.dedup_filtered`).

    Silver is written as a new version below ``silver_path`` and then named by the pointer: a
    job that fails while writing leaves readers on the version before. The counts are
    observed during that write instead of extra scans of the JSON. With ``quarantine_path``
    (or the filter) the JSON is parsed once into a table in the shared scratch folder, from
    which the rejected rows, with their reason and the text of broken lines, are written first.

    When no row passes the gates, the rejects are still written, and Silver is
    left alone: :class:`EmptySilverError`, unless it has no rows yet or
    ``allow_empty`` says to empty it.
    """
    if dedup not in DEDUPS:
        raise ValueError(f"dedup is one of {DEDUPS}")
    raw = bronze_io.scan_raw(spark, bronze_path)
    counts = {}
    if quarantine_path or dedup == "filter":
        parsed = scratch_path(spark, "parsed-bronze")
        raw.withColumn("reject_reason", silver.reason_of(with_lines=True)).write.parquet(parsed)
        raw = spark.read.schema(PARSED).parquet(parsed)
    if quarantine_path:
        rejects = raw.where(F.col("reject_reason").isNotNull())
        rejects.write.mode("overwrite").partitionBy("reject_reason").parquet(quarantine_path)
    obs_raw, obs_clean = Observation("bronze_raw"), Observation("silver_clean")
    if dedup == "filter":       # reads the parsed table several times, so its rows are not observed
        counts["raw_count"] = raw.count()
        clean = silver.dedup_filtered(silver.valid(raw), deterministic).select(*SILVER_COLUMNS)
    else:
        clean = silver.transform(raw.observe(obs_raw, F.count(F.lit(1)).alias("raw_count")), deterministic)
    version = f"v-{uuid.uuid4().hex[:12]}"
    lake.write_silver(clean.observe(obs_clean, F.count(F.lit(1)).alias("clean_count")), f"{silver_path}/{version}")
    if dedup != "filter":
        counts.update(obs_raw.get)
    counts.update(obs_clean.get)
    if not counts["clean_count"] and not allow_empty and lake.has_rows(spark, silver_path):
        lake.drop_version(spark, silver_path, version)
        raise EmptySilverError(f"no valid row below {bronze_path}; {silver_path} is kept")
    lake.publish(spark, silver_path, version)
    return counts


MARTS = ("mart_service_hourly_kpis", "mart_daily_active_users", "mart_error_analytics")


#: Marts in a form that rolls up to any grain (built on demand).
ROLLUPS = {"mart_service_hourly_sketches": marts.service_hourly_sketches,
           "mart_error_sketches": marts.error_sketches,
           "mart_latency_histogram": marts.latency_histogram}


def gold_paths(spark: SparkSession, gold_dir: str) -> dict[str, str]:
    """Folders of the published version of the marts."""
    versions = lake.published(spark, gold_dir)
    if not versions:
        raise FileNotFoundError(f"no published marts in {gold_dir}")
    paths = {n: os.path.join(gold_dir, versions[-1], n) for n in (*MARTS, *ROLLUPS)}
    return {n: p for n, p in paths.items() if n in MARTS or lake.exists(spark, p)}


def build_gold(spark: SparkSession, silver_path: str, gold_dir: str, run_checks: bool = True,
               users: DataFrame | None = None, run_ts: str | None = None, rollups: bool = False) -> dict[str, str]:
    """Seed -> staging checks -> marts -> mart checks -> switch -> users snapshot.

    The marts go to a version folder of their own; only when every check has
    passed does the pointer name it, so a failing check leaves readers on the
    version before. With ``users`` (the dimension's source rows) the seed is
    written and read back first, and at the end the type-2 snapshot takes its
    run at ``run_ts`` (see :func:`scd2.run_snapshot`). ``rollups`` adds the marts that roll up
    to any grain: quantile and distinct-user sketches, and the latency histogram.
    """
    if users is not None:
        seed = os.path.join(gold_dir, "seed_users")
        lake.write_seed(users, seed)
        users = lake.read_seed(spark, seed)
    stg = silver.staging(lake.read_silver(spark, silver_path))
    if run_checks:
        quality.assert_staging(stg)
    version = f"v-{uuid.uuid4().hex[:12]}"
    paths = {n: os.path.join(gold_dir, version, n) for n in MARTS}
    lake.write_table(marts.service_hourly_kpis(stg, apart=True), paths["mart_service_hourly_kpis"])
    lake.write_table(marts.daily_active_users(stg), paths["mart_daily_active_users"])
    lake.write_table(marts.error_analytics(stg, apart=True), paths["mart_error_analytics"])
    if rollups:
        with conf_during(spark, spark__sql__objectHashAggregate__sortBased__fallbackThreshold="4096"):
            for n, build in ROLLUPS.items():     # sketches of so many groups fit in a task
                paths[n] = os.path.join(gold_dir, version, n)
                lake.write_table(build(stg), paths[n])
    if run_checks:
        kpis, dau, errs = (spark.read.parquet(paths[n]) for n in MARTS)
        quality.assert_passes("not_null(marts)", quality.not_null_marts(kpis, dau, errs),
                              "failures")
        quality.assert_passes("assert_error_rate_valid", quality.error_rate_out_of_range(kpis))
    lake.publish(spark, gold_dir, version)
    if users is not None:
        paths["users_snapshot"] = os.path.join(gold_dir, "users_snapshot")
        scd2.run_snapshot(spark, paths["users_snapshot"], users, "user_id", ["plan", "country"], run_ts)
    return paths


def run_all(spark: SparkSession, bronze_rows: DataFrame, root: str, land_mode: str = "overwrite",
            users: DataFrame | None = None, run_ts: str | None = None, table: str | None = None) -> dict:
    """Land -> Silver -> register -> Gold (with seed and snapshot), all under ``root``.

    The catalog keeps one table for the folder (``table``, else a name made
    from ``root``), brought up to date by every run."""
    bronze_path = os.path.join(root, "bronze")
    silver_path = os.path.join(root, "silver")
    gold_dir = os.path.join(root, "gold")
    bronze_io.land(bronze_rows, bronze_path, mode=land_mode)
    counts = run_silver(spark, bronze_path, silver_path)
    table = table or f"silver_{hashlib.md5(root.encode()).hexdigest()[:10]}"
    table = lake.register_partitioned(spark, silver_path, table)
    paths = build_gold(spark, silver_path, gold_dir, users=users, run_ts=run_ts)
    return {"counts": counts, "silver_table": table, "silver": silver_path,
            "bronze": bronze_path, **paths}


def serving_results(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """The four dashboard result sets, read from written marts."""
    p = gold_paths(spark, gold_dir)
    kpis = spark.read.parquet(p["mart_service_hourly_kpis"])
    dau = spark.read.parquet(p["mart_daily_active_users"])
    return {
        "service-health": serving.service_health(kpis),
        "error-trend": serving.error_rate_trend(kpis, with_label=True),
        "latency": serving.latency_summary(kpis),
        "active-users": serving.active_users_by_day(dau),
    }


def export_snapshot(spark: SparkSession, gold_dir: str, out_dir: str, generated_at: str | None = None) -> dict[str, str]:
    """The four result sets + metadata as JSON under ``out_dir``; ``generated_at`` is the run's time (now)."""
    out = {}
    for name, df in serving_results(spark, gold_dir).items():
        out[name] = os.path.join(out_dir, name)
        lake.export_json(df, out[name])
    out["meta"] = os.path.join(out_dir, "meta")
    lake.export_meta(spark, out["meta"], generated_at)
    return out

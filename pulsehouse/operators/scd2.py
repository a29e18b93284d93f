"""Type-2 snapshot of a dimension.

Semantics follow the snapshot config of the reference: ``check`` strategy on
chosen columns (NULL-safe compare) or ``timestamp`` strategy on an
``updated_at`` column; changed keys close their open version and open a new
one; unseen keys open a version; keys missing from the source stay open;
columns outside the checked set never cause a version.

The source must have one row per key: NULL or repeated keys raise
(:func:`assert_keys`) or are split off first (:func:`reject_keys`).

Plan: closed history passes through untouched (no shuffle); open versions and
the source meet in ONE full outer join on the key (a unique key, so no skew),
and a single ``inline`` emits 0, 1 or 2 rows per key.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import lake

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def scd_id(key: Column, ts: Column) -> Column:
    """md5(key || '|' || 'yyyy-MM-dd HH:mm:ss' of the version time)."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(""))))


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


class SnapshotKeyError(ValueError):
    """The source has rows without a key, or keys that occur more than once."""


def _with_copies(source: DataFrame, key: str) -> DataFrame:
    copies = source.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    return source.join(copies, key, "left").select(*source.columns, F.coalesce("_copies", F.lit(0)).alias("_copies"))


def reject_keys(source: DataFrame, key: str) -> DataFrame:
    """Rows that cannot be versioned, with their reason: ``null_key`` or ``repeated_key`` (all
    rows of the key, as none of them is known to be the right one)."""
    reason = F.when(F.col(key).isNull(), F.lit("null_key")).when(F.col("_copies") > 1, F.lit("repeated_key"))
    return (_with_copies(source, key).withColumn("reject_reason", reason)
            .filter(F.col("reject_reason").isNotNull()).drop("_copies"))


def accepted_keys(source: DataFrame, key: str) -> DataFrame:
    """The rows :func:`reject_keys` does not list."""
    return _with_copies(source, key).filter(F.col(key).isNotNull() & (F.col("_copies") == 1)).drop("_copies")


def assert_keys(source: DataFrame, key: str) -> None:
    """Raise unless every row has a key and every key one row (counted per key, map-side first)."""
    per_key = source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.agg(F.sum(F.when(F.col(key).isNull(), F.col("n"))).alias("nulls"),
                      F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated")).first()
    if bad["nulls"] or bad["repeated"]:
        raise SnapshotKeyError(f"{bad['nulls'] or 0} rows with NULL {key}, {bad['repeated']} keys that repeat")


def _open_version(src_cols: list[str], key: str, at: Column, prefix: str = "") -> list[Column]:
    return ([F.col(prefix + c).alias(c) for c in src_cols]
            + [scd_id(F.col(prefix + key), at).alias("dbt_scd_id"),
               at.alias("dbt_updated_at"), at.alias("dbt_valid_from"),
               F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to")])


def initial(source: DataFrame, key: str, run_ts=None, updated_at: str | None = None) -> DataFrame:
    """First run: every source row becomes an open version. Keys are checked first."""
    assert_keys(source, key)
    at = F.col(updated_at).cast("timestamp_ntz") if updated_at else _ts(run_ts)
    return source.select(*_open_version(source.columns, key, at))


def _merge(existing: DataFrame, source: DataFrame, key: str, changed, new_at: Column) -> DataFrame:
    assert_keys(source, key)
    src_cols = source.columns
    snap_cols = existing.columns
    history = existing.filter(F.col("dbt_valid_to").isNotNull())
    current = existing.filter(F.col("dbt_valid_to").isNull()).select(
        *[F.col(c).alias("o_" + c) for c in snap_cols])
    src = source.select(*[F.col(c).alias("s_" + c) for c in src_cols])
    j = current.join(src, F.col("o_" + key) == F.col("s_" + key), "full_outer")
    has_old, has_new = F.col("o_" + key).isNotNull(), F.col("s_" + key).isNotNull()
    is_changed = has_old & has_new & changed
    at = new_at
    old_fields = {c: F.col("o_" + c) for c in snap_cols}
    old_fields["dbt_valid_to"] = F.when(is_changed, at).otherwise(F.col("o_dbt_valid_to"))
    new_fields = dict(zip(src_cols + META, _open_version(src_cols, key, at, "s_")))
    missing = [c for c in snap_cols if c not in new_fields]
    if missing:
        raise ValueError(f"source lacks snapshot columns {missing}")
    # structs are built by name in the snapshot's column order (casts are positional)
    old_row = F.when(has_old, F.struct(*[old_fields[c].alias(c) for c in snap_cols]))
    new_row = F.when(has_new & (~has_old | is_changed),
                     F.struct(*[new_fields[c].alias(c) for c in snap_cols]))
    row_type = _struct_type(existing, snap_cols)
    out = (j.select(F.inline(F.filter(F.array(old_row.cast(row_type), new_row.cast(row_type)),
                                      lambda r: r.isNotNull())))
           .select(*snap_cols))
    return history.select(*snap_cols).unionByName(out)


def _struct_type(existing: DataFrame, cols: list[str]) -> str:
    return "struct<" + ",".join(f"`{c}`:{existing.schema[c].dataType.simpleString()}" for c in cols) + ">"


def snapshot_check(existing: DataFrame | None, source: DataFrame, key: str,
                   check_cols: list[str], run_ts) -> DataFrame:
    """One run of the check strategy at time ``run_ts`` (a parameter, so runs repeat)."""
    if existing is None:
        return initial(source, key, run_ts)
    changed = None
    for c in check_cols:
        diff = ~F.col("o_" + c).eqNullSafe(F.col("s_" + c))
        changed = diff if changed is None else (changed | diff)
    return _merge(existing, source, key, changed, _ts(run_ts))


def snapshot_timestamp(existing: DataFrame | None, source: DataFrame, key: str,
                       updated_at: str = "updated_at") -> DataFrame:
    """Timestamp strategy: a newer ``updated_at`` than the open version's is a change."""
    if existing is None:
        return initial(source, key, updated_at=updated_at)
    new_at = F.col("s_" + updated_at).cast("timestamp_ntz")
    changed = new_at > F.col("o_dbt_updated_at")
    return _merge(existing, source, key, changed, new_at)


def current(snapshot: DataFrame) -> DataFrame:
    """Open versions only (valid_to IS NULL)."""
    return snapshot.filter(F.col("dbt_valid_to").isNull())


def as_of(snapshot: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: valid_from <= ts < valid_to (open end = now)."""
    t = _ts(ts)
    return snapshot.filter((F.col("dbt_valid_from") <= t)
                           & (F.col("dbt_valid_to").isNull() | (t < F.col("dbt_valid_to"))))


# --- the stored snapshot (S7) ------------------------------------------------
#
# base/_published          pointer: the runs, oldest first
# base/<run>/closed        versions the run closed
# base/<run>/open/b=<n>    open versions of the hash buckets the run rewrote
# base/<run>/buckets       which run holds each bucket's open versions, as of this run

BUCKET_ROWS = 1_000_000        # keys a bucket of a new store is meant to hold
MIN_BUCKETS, MAX_BUCKETS = 8, 4096
MANIFEST = "b int, run string, n int"


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n).cast("bigint")).cast("int")


def _digest(cols: list[str]) -> Column:
    """128 bits over the checked columns; NULL and empty differ."""
    return F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]),
                           {"ignoreNullFields": "false"}))


def manifest(spark: SparkSession, base: str, run: str) -> dict[int, str]:
    """bucket -> run that holds it, for all buckets of the store (a bounded number)."""
    rows = spark.read.schema(MANIFEST).parquet(f"{base}/{run}/buckets").collect()
    return {r["b"]: r["run"] for r in rows}


def _schema(spark: SparkSession, base: str, run: str):
    return spark.read.parquet(f"{base}/{run}/closed").schema


def read_open(spark: SparkSession, base: str, run: str, buckets: list[int] | None = None) -> DataFrame:
    """Open versions as of a published run; of some buckets only, none of the other folders is opened."""
    held = manifest(spark, base, run)
    paths = [f"{base}/{r}/open/b={b}" for b, r in sorted(held.items())
             if r and (buckets is None or b in buckets)]
    schema = _schema(spark, base, run)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def changed_buckets(open_versions: DataFrame, source: DataFrame, key: str, check_cols: list[str], n: int) -> list[int]:
    """Buckets in which a source row opens a version: its key is new, or a checked column differs.

    Only keys and digests of the checked columns meet; no other column of the store is read."""
    old = open_versions.select(F.col(key).alias("_k"), _digest(check_cols).alias("_old"))
    new = source.select(key, _digest(check_cols).alias("_new"))
    differs = new.join(old, F.col(key) == F.col("_k"), "left").where(~F.col("_new").eqNullSafe(F.col("_old")))
    return sorted(r["b"] for r in differs.select(bucket_of(key, n).alias("b")).distinct().collect())


def run_snapshot(spark: SparkSession, base: str, source: DataFrame, key: str, check_cols: list[str], run_ts,
                 rejects: str | None = None, buckets: int | None = None) -> DataFrame:
    """One run of the check strategy on the snapshot stored below ``base``; the history after it.

    Open versions lie in hash buckets of the key. A run compares keys and digests first and
    then reads, joins and rewrites the buckets with a change; the others stay where an earlier
    run wrote them. Closed history of earlier runs is never read or written again. Readers
    see a run once the pointer names it, so a run that fails, or is retried, leaves the
    published history as it was. A store keeps its number of buckets; a new one gets ``buckets``,
    or as many as its source's keys call for. (A store without buckets gets them on its next run.)

    Rows of ``source`` with a NULL or repeated key go to ``rejects``; without that folder they raise.
    """
    if rejects is not None:
        reject_keys(source, key).write.mode("overwrite").parquet(rejects)
        source = accepted_keys(source, key)
    runs = lake.published(spark, base)
    run = f"run-{len(runs):06d}-{uuid.uuid4().hex[:8]}"
    bucketed = bool(runs) and lake.exists(spark, f"{base}/{runs[-1]}/buckets")
    if bucketed:
        assert_keys(source, key)
        held = manifest(spark, base, runs[-1])
        buckets = len(held)
        touched = changed_buckets(read_open(spark, base, runs[-1]), source, key, check_cols, buckets)
        before = read_open(spark, base, runs[-1], touched)
        after = snapshot_check(before, source.where(bucket_of(key, buckets).isin(touched)), key, check_cols, run_ts)
    else:
        buckets = buckets or min(MAX_BUCKETS, max(MIN_BUCKETS, source.count() // BUCKET_ROWS))
        held = dict.fromkeys(range(buckets))
        before = spark.read.parquet(f"{base}/{runs[-1]}/open") if runs else None
        after = snapshot_check(before, source, key, check_cols, run_ts)
    written = scratch_path(spark, "users-snapshot-run")
    after.write.parquet(written)              # once: two folders are made from it
    after = spark.read.schema(after.schema).parquet(written)
    after.filter(F.col("dbt_valid_to").isNotNull()).write.parquet(f"{base}/{run}/closed")
    (current(after).withColumn("b", bucket_of(key, buckets)).hint("rebalance", "b")
     .write.partitionBy("b").parquet(f"{base}/{run}/open"))
    if not bucketed:
        touched = [r["b"] for r in current(after).select(bucket_of(key, buckets).alias("b")).distinct().collect()]
    held.update(dict.fromkeys(touched, run))
    rows = spark.createDataFrame([(b, r, buckets) for b, r in sorted(held.items())], MANIFEST)
    rows.coalesce(1).write.parquet(f"{base}/{run}/buckets")
    lake.publish(spark, base, run)
    return read_history(spark, base)


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """All versions of the published snapshot: closed ones of every run, open ones of the last."""
    runs = lake.published(spark, base)
    if not runs:
        raise FileNotFoundError(f"no published snapshot in {base}")
    closed = spark.read.schema(_schema(spark, base, runs[-1])).parquet(*[f"{base}/{r}/closed" for r in runs])
    return closed.unionByName(read_open(spark, base, runs[-1]))

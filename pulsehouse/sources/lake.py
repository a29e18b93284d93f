"""Parquet tables of the lake: Silver sink/scan (S2, S4), mart sink (S5),
seed CSV (S3), catalog registration (S12) and SQL over it (S13), JSON export
(S8, S9)."""
from __future__ import annotations

import logging
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import SILVER, SILVER_PARTITIONS, USERS


#: Columns by which single events or users are looked up: a Bloom filter per row group, as large as its values need.
LOOKUPS = ["event_id", "user_id"]


def write_silver(silver: DataFrame, path: str, dynamic: bool = False,
                 max_records_per_file: int = 2_000_000, row_group_mb: int = 128) -> list[tuple]:
    """Overwrite a Silver folder partitioned by (event_date, service), snappy Parquet. Returns
    the partitions written, observed while writing.

    REBALANCE on the partition keys gives few files per folder while AQE
    splits a hot (date, service) into several tasks, so one service holding a
    third of the traffic does not become a single writer. ``dynamic``
    replaces only the partitions present in ``silver``.

    Inside a file rows are sorted by user (one sort with the one that a partitioned write does
    anyway), which narrows the pages a user's rows are on, and the LOOKUPS columns have Bloom
    filters, so that a point look-up skips row groups without reading them.
    """
    seen = Observation()
    keys = F.collect_set(F.struct(*[F.col(c) for c in SILVER_PARTITIONS])).alias("keys")
    rows = silver.hint("rebalance", *SILVER_PARTITIONS).sortWithinPartitions(*SILVER_PARTITIONS, "user_id")
    w = (rows.observe(seen, keys).write.mode("overwrite").partitionBy(*SILVER_PARTITIONS)
         .option("maxRecordsPerFile", max_records_per_file).option("parquet.block.size", row_group_mb << 20))
    for c in LOOKUPS:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", "true")
             .option("parquet.bloom.filter.adaptive.enabled", "true")      # from 1 MB down to 512 bytes
             .option(f"parquet.bloom.filter.candidates.number#{c}", 12))
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return sorted((tuple(r) for r in seen.get["keys"] or []), key=str)


def silver_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds Silver's rows: the published version's below ``path``, or ``path``
    itself where no version was ever published."""
    versions = published(spark, path)
    return f"{path}/{versions[-1]}" if versions else path


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver by path (its published version), with its declared types (a service named ``007``
    stays text, an empty folder reads as no rows); filters on event_date/service prune folders."""
    return spark.read.schema(SILVER).parquet(silver_folder(spark, path))


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a Silver folder exists and holds a row (reads one row at most)."""
    return exists(spark, silver_folder(spark, path)) and bool(read_silver(spark, path).head(1))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that holds it."""
    fs, at = _fs(spark, path)
    return fs.exists(at)


def drop_version(spark: SparkSession, base: str, version: str) -> None:
    """Delete the folder of a version that is not (or no longer) the current one."""
    if version in published(spark, base)[-1:]:
        raise ValueError(f"{version} is the current version of {base}")
    fs, at = _fs(spark, f"{base}/{version}")
    fs.delete(at, True)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the folders of all published versions but the last ``keep``; the names deleted."""
    gone = [v for v in published(spark, base)[:-max(1, keep)] if exists(spark, f"{base}/{v}")]
    for v in gone:
        drop_version(spark, base, v)
    return gone


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild of a mart (CTAS semantics)."""
    df.write.mode("overwrite").parquet(path)


POINTER = "version string, published_at timestamp"


def publish(spark: SparkSession, base: str, version: str) -> None:
    """Make ``version`` the current one of ``base``: one appended row, so readers see
    the old or the new version and never half of one."""
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{base}/_published")


def published(spark: SparkSession, base: str) -> list[str]:
    """The published versions of ``base``, oldest first (one row a run)."""
    if not exists(spark, f"{base}/_published"):
        return []
    rows = spark.read.schema(POINTER).parquet(f"{base}/_published").orderBy("published_at", "version").collect()
    return list(dict.fromkeys(r["version"] for r in rows))


def write_seed(users: DataFrame, path: str) -> None:
    users.write.mode("overwrite").option("header", "true").csv(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with declared types (no inference pass)."""
    return spark.read.schema(USERS).option("header", "true").csv(path)


LOOKED = "pulsehouse.files_looked_at"     # table property: up to when files' schemas are known


def _file_columns(spark: SparkSession, path: str, since: str | None) -> StructType:
    """Merged schema of the Parquet files written after ``since`` (UTC; None: of all)."""
    read = spark.read.option("mergeSchema", "true").option("timeZone", "UTC")
    if since:
        read = read.option("modifiedAfter", since)
    try:
        return read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):   # no such file
            return StructType()
        raise


def _partition_spec(row: tuple, partitions) -> str:
    values = ["'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for v in row]
    return "PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in zip(partitions, values)) + ")"


def _load_partitions(spark: SparkSession, name: str, partitions, touched: list[tuple] | None) -> None:
    """Add the ``touched`` partitions to the table's list, 500 a statement; without them (or
    where one has no value to name it by) look through the whole folder."""
    if touched is None or any(v in (None, "") for row in touched for v in row):
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
        return
    specs = [_partition_spec(row, partitions) for row in touched]
    for at in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE `{name}` ADD IF NOT EXISTS " + " ".join(specs[at:at + 500]))


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED `{name}`").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"] if rows else ""


def _same_place(spark: SparkSession, a: str, b: str) -> bool:
    def full(p):
        fs, at = _fs(spark, p)
        return fs.makeQualified(at).toString().rstrip("/")
    return full(a) == full(b)


def register_partitioned(spark: SparkSession, path: str, name: str | None = None,
                         partitions=SILVER_PARTITIONS, added: StructType | None = None,
                         touched: list[tuple] | None = None) -> str:
    """Register a partitioned Parquet folder as a catalog table and load its
    partition list (the crawler / partition-repair step). Returns the name.

    The schema is the declared one plus ``added`` plus the columns found in the
    files, whose footers are read once: re-registering looks only at files
    written since (an hour earlier, as clocks differ), in new partitions or old.
    New columns are added, columns gone are only logged (the table keeps them).

    The folder is listed once, by the first registration; later ones add only the
    partitions ``touched`` by a write (what :func:`write_silver` returns; None: list again).
    Where ``path`` has published versions the table stands on the current one; a new version
    is a new folder, so the table is made anew on it (the data is external and stays).
    """
    name = name or f"silver_{uuid.uuid4().hex[:10]}"
    path = silver_folder(spark, path)
    now = (datetime.now(timezone.utc) - timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%S")
    known_table = spark.catalog.tableExists(name)
    old = spark.table(name).schema if known_table else StructType()
    moved = known_table and not _same_place(spark, _location(spark, name), path)
    since = None
    if known_table and not moved:
        since = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{name}`").collect()}.get(LOOKED)
    found = _file_columns(spark, path, since)
    files, names = StructType(), set()
    for f in [*SILVER.fields, *(added.fields if added else []), *found.fields]:
        if f.name.lower() not in names:
            names.add(f.name.lower())
            files = files.add(f)
    known = {f.name.lower() for f in old.fields}
    gone = sorted(known - names)
    if gone and len(found):     # without newer files nothing is known to be gone
        logging.getLogger(__name__).warning(
            "table %s: columns %s no longer in the newest files; kept", name, gone)
    if known_table and not moved:
        new = [f for f in files.fields if f.name.lower() not in known]
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE `{name}` ADD COLUMNS ({cols})")
        _load_partitions(spark, name, partitions, touched)
    else:
        kept = [f for f in old.fields if f.name.lower() in gone and f.name not in partitions]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*files.fields, *kept])
        if moved:
            spark.sql(f"DROP TABLE `{name}`")
        spark.sql(f"CREATE TABLE `{name}` ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
        _load_partitions(spark, name, partitions, None)
    spark.sql(f"ALTER TABLE `{name}` SET TBLPROPERTIES ('{LOOKED}' = '{now}')")
    return name


def export_json(df: DataFrame, path: str) -> None:
    """One JSON Lines file per result set; NULL fields are written, not dropped.

    Only for dashboard results, whose size is bounded by services x hours.
    """
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_meta(spark: SparkSession, path: str, generated_at: str | None = None) -> None:
    """``generated_at`` in UTC ISO-8601 seconds, one row: the given run time (an instant as text), else now."""
    at = F.current_timestamp() if generated_at is None else F.lit(generated_at).cast("timestamp")
    (spark.range(1).select(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("generated_at"))
     .coalesce(1).write.mode("overwrite").json(path))

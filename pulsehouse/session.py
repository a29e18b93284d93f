"""Session set-up and the shared scratch location.

Every function in this package takes a live ``SparkSession``; nothing here
starts one implicitly except :func:`build_session` (CLI, tests, bench).
"""
from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on (hour/date derivation is UTC) or that the
# plans rely on at scale (AQE re-plans joins, coalesces and splits skew).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

# State of streaming queries: off the heap in RocksDB, a batch's checkpoint being its changes
# only, so that state may outgrow the executors' memory and a commit does not rewrite it.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def cluster_conf(total_cores: int, partition_mb: int = 128) -> dict:
    """Sizing for a cluster session (pass as ``build_session(extra=...)``).

    Shuffles start with ~6 partitions per core so no reducer task outgrows
    its memory share at 100 TB inputs; AQE then merges them to about
    ``partition_mb`` and splits any partition 5x the median and above 256 MB
    (skew). Input splits are twice the shuffle target because scans are
    column-pruned Parquet.
    """
    cores = max(1, int(total_cores))
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * cores)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(400, 6 * cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": f"{2 * partition_mb}m",
    }


def build_session(master: str | None = None, app: str = "pulsehouse",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for CLI runs, tests and the bench. UI stays off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**SEMANTIC_CONF, **SCALE_CONF, **STREAM_CONF,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else built."""
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in {**SCALE_CONF, **STREAM_CONF}.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


@contextmanager
def conf_during(spark: SparkSession, **values: str):
    """Session settings for one eager action, put back afterwards (``__`` stands for a dot)."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session (tests, bench) may fall back to a temp folder; on a cluster an
    unset setting is an error, since executors cannot share a driver-local
    folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", None)) or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared "
                               "storage for intermediate tables")
        if master not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[master] = tempfile.mkdtemp(prefix="pulsehouse-ckpt-")
        configured = _LOCAL_FALLBACK[master]
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")

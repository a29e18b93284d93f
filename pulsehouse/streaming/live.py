"""Structured Streaming counterparts of the batch layers.

Bronze JSON files -> streaming Silver (watermark, dedup within watermark)
-> 1-hour tumbling KPIs per service. Sinks are ``foreachBatch`` writers keyed
by the micro-batch id with dynamic partition overwrite, so a batch replayed
after a failure rewrites exactly its own folders (exactly-once output with
the checkpoint).

Differences from batch, by design: rows later than the watermark are dropped
(:func:`late_rows` counts them), and the KPI stream, which updates open hours, estimates
distinct users; :func:`distinct_users_stream` counts them exactly, once an hour is closed,
and :func:`exact_hourly_users` from the Silver sink, open hours included.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.expressions import PERCENTILE_ACCURACY, count_if_true, latency_percentiles, pct
from ..operators import silver as silver_ops
from ..schemas import BRONZE, SILVER, SILVER_COLUMNS
from ..session import conf_during
from ..sources import lake

KPI_KEYS = ["service", "event_date", "event_hour"]


def bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New JSON files below ``path`` with the fixed Bronze schema."""
    r = spark.readStream.schema(BRONZE).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def silver_stream(bronze: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """T2 + T3: the batch gates, then dedup on event_id within the watermark.

    State per event_id lives until the watermark passes it, so state is
    bounded by the event rate times the watermark delay.
    """
    return (silver_ops.derive(bronze).filter(silver_ops.gate_condition())
            .withWatermark("event_ts", watermark)
            .dropDuplicatesWithinWatermark(["event_id"])
            .select(*SILVER_COLUMNS))


def hourly_kpis_stream(silver: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """T4 + T5: tumbling 1-hour KPIs per service, same measures as the batch
    mart except ``approx_unique_users`` (HyperLogLog++)."""
    errors = count_if_true(F.col("is_error"))
    total = F.count(F.lit(1))
    agg = (silver.groupBy(F.window("event_ts", "1 hour"), "service")
           .agg(total.alias("total_requests"),
                errors.alias("error_count"),
                count_if_true(F.col("is_server_error")).alias("server_error_count"),
                pct(errors, total).alias("error_rate_pct"),
                F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
                *latency_percentiles(accuracy=accuracy),
                F.approx_count_distinct("user_id").alias("approx_unique_users")))
    return agg.select("service", F.to_date(F.col("window.start")).alias("event_date"),
                      F.hour(F.col("window.start")).alias("event_hour"),
                      *[c for c in agg.columns if c not in ("window", "service")])


def distinct_users_stream(silver: DataFrame) -> DataFrame:
    """T5: exact distinct users per (service, hour), counted in the stream itself.

    A second stateful stage keeps the (service, hour, user) triples it has seen until the
    watermark passes their hour, the third counts what comes out of it; with the event dedup
    before them the chain runs in append mode, and an hour is emitted once, when it is closed.
    State follows the users of open hours, not their requests; a user with most requests is
    one triple an hour. NULL users are not counted (an hour of them alone counts 0).
    """
    hours = silver.select(F.window("event_ts", "1 hour").alias("window"), "service", "user_id")
    once = hours.dropDuplicates(["window", "service", "user_id"])
    users = once.groupBy("window", "service").agg(F.count("user_id").alias("unique_users"))
    return users.select("service", F.to_date(F.col("window.start")).alias("event_date"),
                        F.hour(F.col("window.start")).alias("event_hour"), "unique_users")


def _batch_writer(out: str, partitions: list[str]):
    """Writes a micro-batch under its own ``batch_id`` folders, below the data's partitions so
    that a date filter prunes before batches are listed. REBALANCE gives one file per folder
    and batch unless the folder is large; a stateful query runs without AQE, which ignores the
    hint, so AQE is on for the write alone (the state's own shuffle is planned by then)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keys = [*partitions, "batch_id"]
        with conf_during(batch.sparkSession, spark__sql__adaptive__enabled="true"):
            (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", *keys)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*keys).parquet(out))
    return write


def compact_silver(spark: SparkSession, sink: str, silver_path: str, before: str) -> int:
    """Copy the sink's rows of dates before ``before`` (closed dates: the watermark has passed
    them) into the partitioned Silver, few files a folder, replacing only those dates. Returns
    the number of rows. The sink's folders of these dates may then be removed."""
    closed = read_silver_sink(spark, sink).filter(F.col("event_date") < F.lit(before).cast("date"))
    lake.write_silver(closed, silver_path, dynamic=True)
    return lake.read_silver(spark, silver_path).filter(F.col("event_date") < F.lit(before).cast("date")).count()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark and were left out, over the query's recent progress."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def start_silver_sink(stream: DataFrame, out: str, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append new Silver rows; replays overwrite their own batch folders."""
    w = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(_batch_writer(out, ["event_date", "service"])))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def start_kpis_sink(stream: DataFrame, out: str, checkpoint: str,
                    available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Update mode; each batch writes the windows it changed as a new
    version. Finalised windows leave state once the watermark passes them."""
    w = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(_batch_writer(out, ["event_date"])))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def start_users_sink(stream: DataFrame, out: str, checkpoint: str,
                     available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append mode; each closed hour is written once, replays overwrite their own batch folders."""
    w = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(_batch_writer(out, ["event_date"])))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes the query's stateful stages hold after its last batch, and how many stages."""
    last = query.lastProgress
    ops = last.stateOperators if last else []
    return {"stages": len(ops), "rows": sum(o.numRowsTotal for o in ops), "bytes": sum(o.memoryUsedBytes for o in ops)}


SINK = StructType([*SILVER.fields, StructField("batch_id", LongType(), True)])


def read_silver_sink(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SINK).parquet(out).select(*SILVER_COLUMNS)


def exact_hourly_users(silver_sink: DataFrame) -> DataFrame:
    """Exact distinct users per (service, hour) from the written streaming Silver (T5): a
    streaming aggregation can only estimate them, the rows it came from are there to count."""
    return silver_sink.groupBy(*KPI_KEYS).agg(F.count_distinct("user_id").alias("unique_users"))


def read_users_sink(spark: SparkSession, out: str) -> DataFrame:
    schema = "service string, event_hour int, unique_users bigint, event_date date, batch_id bigint"
    return spark.read.schema(schema).parquet(out).select(*KPI_KEYS, "unique_users")


def read_kpis_sink(spark: SparkSession, out: str) -> DataFrame:
    """Latest version of every window: ``max_by`` over batch ids (a partial
    aggregation, so no window holds more than its own versions)."""
    df = spark.read.parquet(out)
    values = [c for c in df.columns if c not in KPI_KEYS + ["batch_id"]]
    latest = F.max_by(F.struct(*[F.col(c) for c in values]), F.col("batch_id")).alias("_v")
    return (df.groupBy(*KPI_KEYS).agg(latest)
            .select(*KPI_KEYS, *[F.col(f"_v.{c}").alias(c) for c in values]))

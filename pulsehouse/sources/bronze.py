"""Bronze: JSON Lines landing (S10, S11) and scan.

Landing layout: ``service=<s>/year=YYYY/month=MM/day=DD/hour=HH/`` with the
JSON body still carrying ``service`` (the text writer keeps the body intact
while the partition values go to the path). Months, days and hours stay
zero-padded strings.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE, BRONZE_COLUMNS, RAW_LINE
from ..session import conf_during

LAYOUT = ["service", "year", "month", "day", "hour"]
LAYOUT_SCHEMA = "value string, service string, year string, month string, day string, hour string"


def body() -> Column:
    """A Bronze row as its JSON line; NULL fields are written."""
    return F.to_json(F.struct(*[F.col(c) for c in BRONZE_COLUMNS]), {"ignoreNullFields": "false"})


def land(df: DataFrame, path: str, arrival: Column | str = "arrival_ts",
         mode: str = "append", rows_per_file: int = 500_000, line: Column | None = None) -> None:
    """Write Bronze rows as JSON Lines under the hour/service layout.

    ``arrival`` is the hour the batch belongs to (the landing hour, not the
    parsed body timestamp, which may be broken). Rows without that column
    land under the current UTC hour, as a live collector would.

    One pass over the source: REBALANCE on the layout brings a folder's rows
    together, and from the measured sizes AQE gives a hot service-hour several
    writer tasks and quiet ones a shared task. ``rows_per_file`` only cuts
    files; no row is left out. ``line`` replaces the text of a row (a collector's own line).
    """
    if isinstance(arrival, str):
        arr = (F.col(arrival) if arrival in df.columns
               else F.date_trunc("hour", F.current_timestamp()))
    else:
        arr = arrival
    out = df.select(
        (body() if line is None else line).alias("value"),
        F.col("service").alias("service"),
        F.date_format(arr, "yyyy").alias("year"),
        F.date_format(arr, "MM").alias("month"),
        F.date_format(arr, "dd").alias("day"),
        F.date_format(arr, "HH").alias("hour"),
    )
    # many small folders: the time goes into opening files, so a small load is spread over the
    # cores too; the target size of large ones is not touched
    with conf_during(df.sparkSession, spark__sql__adaptive__coalescePartitions__minPartitionSize="16k"):
        (out.hint("rebalance", *LAYOUT).write.mode(mode).partitionBy(*LAYOUT)
         .option("maxRecordsPerFile", rows_per_file)
         .text(path))


def backfill(df: DataFrame, path: str, end_ts: str, hours: int,
             arrival: str = "arrival_ts") -> None:
    """Land the last ``hours`` hour windows ending with the hour of ``end_ts``.

    One job over the source (a range predicate Parquet can skip row groups
    with), not one job per hour.
    """
    end_hour = F.date_trunc("hour", F.lit(end_ts).cast("timestamp_ntz"))
    lo = end_hour - F.make_interval(hours=F.lit(hours - 1))
    hi = end_hour + F.expr("INTERVAL 1 HOUR")
    a = F.col(arrival).cast("timestamp_ntz")
    land(df.filter((a >= lo) & (a < hi)), path, arrival)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All JSON files below ``path`` with the fixed Bronze schema.

    Recursive lookup turns partition discovery off, so ``service`` comes from
    the body, never from the folder name. Broken lines become all-NULL rows
    (PERMISSIVE) and a non-integer status becomes NULL; Silver's gates decide.
    """
    return scan_raw(spark, path).drop(RAW_LINE)


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`scan`, plus ``raw_line``: the text of a line that could not be read whole (broken
    JSON, or a value of the wrong type); NULL for all others."""
    return (spark.read.schema(StructType([*BRONZE.fields, StructField(RAW_LINE, StringType(), True)]))
            .option("recursiveFileLookup", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RAW_LINE).json(path))


def scan_layout(spark: SparkSession, path: str) -> DataFrame:
    """The landed files with their layout columns as strings (for audits)."""
    return spark.read.schema(LAYOUT_SCHEMA).text(path)

"""Bronze -> Silver: parse, derive, gate, deduplicate."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import error_flag, parse_ts, server_error_flag
from ..schemas import BRONZE_COLUMNS, RAW_LINE, SILVER_COLUMNS, STAGING_COLUMNS
from . import key_filter


def derive(df: DataFrame) -> DataFrame:
    """Bronze columns + event_ts, event_date, event_hour, is_error, is_server_error."""
    ts = parse_ts(F.col("timestamp"))
    return df.select(
        *BRONZE_COLUMNS,
        ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).alias("event_hour"),
        error_flag(F.col("status_code")).alias("is_error"),
        server_error_flag(F.col("status_code")).alias("is_server_error"),
    )


def gate_condition() -> Column:
    """Rows Silver keeps: event_id, a parsable timestamp and service present."""
    return (F.col("event_id").isNotNull() & F.col("event_ts").isNotNull()
            & F.col("service").isNotNull())


def broken_line() -> Column:
    """A line of which no field could be read (needs the ``raw_line`` column)."""
    nothing = F.coalesce(*[F.col(c).cast("string") for c in BRONZE_COLUMNS]).isNull()
    return F.col(RAW_LINE).isNotNull() & nothing


def reject_reason(ts: Column | None = None, with_lines: bool = False) -> Column:
    """First failed gate, in gate order; NULL for rows that pass. ``with_lines``: a line that
    could not be read at all is a ``broken_line``."""
    ts = F.col("event_ts") if ts is None else ts
    gates = [(F.col("event_id").isNull(), "missing_event_id"), (ts.isNull(), "bad_timestamp"),
             (F.col("service").isNull(), "missing_service")]
    if with_lines:
        gates.insert(0, (broken_line(), "broken_line"))
    out = F.when(gates[0][0], F.lit(gates[0][1]))
    for failed, name in gates[1:]:
        out = out.when(failed, F.lit(name))
    return out


def valid(bronze: DataFrame) -> DataFrame:
    """Derived rows that pass the gates, before dedup."""
    return derive(bronze.select(*BRONZE_COLUMNS)).filter(gate_condition())


def reason_of(with_lines: bool = False) -> Column:
    """``reject_reason`` as a function of the Bronze columns themselves."""
    return reject_reason(parse_ts(F.col("timestamp")), with_lines)


def dedup(df: DataFrame, deterministic: bool = False) -> DataFrame:
    """One row per event_id.

    Both forms are aggregations, so a key repeated millions of times is
    collapsed map-side before the shuffle (no single hot task).
    ``deterministic`` keeps the smallest row by (event_ts, other columns)
    instead of an arbitrary twin.
    """
    if not deterministic:
        return df.dropDuplicates(["event_id"])
    others = [c for c in df.columns if c != "event_id"]
    order = ["event_ts"] + [c for c in others if c != "event_ts"]
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_best")
    return (df.groupBy("event_id").agg(best)
            .select("event_id", *[F.col(f"_best.{c}").alias(c) for c in order])
            .select(*df.columns))


#: Share of rows per repeated key above which a filter would let most rows through anyway.
FILTER_MAX_SHARE = 0.2


def dedup_filtered(df: DataFrame, deterministic: bool = True) -> DataFrame:
    """As :func:`dedup`, moving only rows whose key may repeat: surely unique rows (by a filter
    of repeated key hashes) bypass the aggregation and its shuffle. ``df`` is read three times,
    once for the keys alone, so it should be a written table.

    The keys are counted first; where more than FILTER_MAX_SHARE of the rows' number are
    repeated keys (a replay of everything), all rows are aggregated at once. The result is
    the same either way."""
    hashes, n = key_filter.repeated(df, "event_id")
    if n > FILTER_MAX_SHARE * df.count():
        return dedup(df, deterministic).select(*df.columns)
    unique, rest = key_filter.split(df, hashes, n, "event_id")
    return unique.unionByName(dedup(rest, deterministic).select(*df.columns))


def transform(bronze: DataFrame, deterministic: bool = False) -> DataFrame:
    """Silver rows. Gates run *before* dedup so an invalid twin cannot win."""
    return dedup(valid(bronze), deterministic).select(*SILVER_COLUMNS)


def staging(silver: DataFrame) -> DataFrame:
    """The 13-column staging view over Silver."""
    return silver.select(*STAGING_COLUMNS)


def quarantine(bronze: DataFrame) -> DataFrame:
    """Rejected Bronze rows with the reason (one scan; no shuffle). Rows that come with their
    ``raw_line`` keep it, so a broken line's text is not lost."""
    lines = [RAW_LINE] if RAW_LINE in bronze.columns else []
    return (bronze.select(*BRONZE_COLUMNS, *lines)
            .withColumn("reject_reason", reason_of(bool(lines)))
            .filter(F.col("reject_reason").isNotNull()))


def stage_counts(bronze: DataFrame) -> DataFrame:
    """raw_count and clean_count (after gates and dedup) in one aggregation.

    One row per event_id first (partial aggregation absorbs hot ids), then a
    global sum; the same numbers the job reports through ``observe``.
    """
    per_key = (derive(bronze.select(*BRONZE_COLUMNS))
               .withColumn("_ok", gate_condition())
               .groupBy("event_id")
               .agg(F.count(F.lit(1)).alias("copies"),
                    F.max(F.col("_ok").cast("int")).alias("any_ok")))
    # NULL event_id rows are all rejected by the gate, so any_ok is 0 there.
    return per_key.agg(F.sum("copies").cast("bigint").alias("raw_count"),
                       F.sum("any_ok").cast("bigint").alias("clean_count"))

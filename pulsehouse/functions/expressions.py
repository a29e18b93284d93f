"""Column expressions shared by the jobs. All built-in, JVM-side."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default accuracy of the latency sketches. 10,000 is Spark's default: a
# bounded-memory, mergeable sketch (relative rank error 1e-4), which is what
# keeps hour/service groups of any size inside one buffer per task.
PERCENTILE_ACCURACY = 10000


def parse_ts(text: Column) -> Column:
    """ISO-8601 text (offset and fraction optional) -> timestamp; bad -> NULL."""
    return F.try_to_timestamp(text)


def error_flag(status: Column) -> Column:
    """status >= 400; NULL status stays NULL (three-valued)."""
    return status >= F.lit(400)


def server_error_flag(status: Column) -> Column:
    return status >= F.lit(500)


def count_if_true(flag: Column) -> Column:
    """sum(case when flag then 1 else 0 end): NULL/false count as 0, bigint."""
    return F.sum(F.when(flag, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(100 * part / whole, scale) in double; NULL when whole is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), scale)


def ratio(num: Column, den: Column, scale: int = 1) -> Column:
    """round(num * 1.0 / den, scale); a zero denominator gives NULL."""
    return F.round(F.try_divide(num * F.lit(1.0), den.cast("double")), scale)


def latency_percentiles(col: str = "latency_ms", qs=(0.5, 0.95, 0.99),
                        accuracy: int = PERCENTILE_ACCURACY,
                        names=("p50_latency_ms", "p95_latency_ms", "p99_latency_ms")):
    """One mergeable sketch for all quantiles (bounded memory per group)."""
    sketch = F.percentile_approx(F.col(col), list(qs), accuracy)
    return [sketch[i].alias(n) for i, n in enumerate(names)]


def exact_percentiles(df: DataFrame, keys: list[str], col: str, qs, names,
                      total_name: str | None = None, weight: str | None = None) -> DataFrame:
    """Exact nearest-rank quantiles per group: the smallest value whose
    cumulative count reaches ceil(q * n), n = non-NULL values of the group.

    Works on a histogram, one row per (group, distinct value), built with
    partial aggregation; the running sum runs over that histogram, so memory
    follows the number of distinct values (latencies in ms), never the number
    of rows, and a group holding a third of all rows is no harder than others.
    Ranks use decimal arithmetic so q * n is exact. ``total_name`` adds the
    group's row count (NULLs included) from the same histogram. ``weight`` names a
    column with the number of rows a row stands for (a stored histogram).
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")
    hist = df.groupBy(*keys, col).agg(rows.alias("_c"))
    valid = F.when(F.col(col).isNotNull(), F.col("_c")).otherwise(F.lit(0))
    running = Window.partitionBy(*keys).orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    h = (hist.withColumn("_cum", F.sum(valid).over(running))
         .withColumn("_n", F.sum(valid).over(whole)))
    picks = []
    for q, n in zip(qs, names):
        rank = F.ceil(F.col("_n") * F.lit(q).cast("decimal(12,10)"))
        picks.append(F.min(F.when(F.col(col).isNotNull() & (F.col("_cum") >= rank),
                                  F.col(col))).alias(n))
    if total_name:
        picks.append(F.sum("_c").alias(total_name))
    return h.groupBy(*keys).agg(*picks)


def hour_label(date_col: Column, hour_col: Column) -> Column:
    """'YYYY-MM-DD HH:00' built by string concatenation."""
    return F.concat(date_col.cast("string"), F.lit(" "),
                    F.lpad(hour_col.cast("string"), 2, "0"), F.lit(":00"))


def health_flag(rate: Column, threshold: float = 10.0) -> Column:
    """'high' when the error rate exceeds the threshold, else 'ok'."""
    return F.when(rate > F.lit(threshold), F.lit("high")).otherwise(F.lit("ok"))


def hour_start(date_col: Column, hour_col: Column) -> Column:
    """Start of the (date, hour) bucket as timestamp_ntz."""
    return F.make_timestamp_ntz(F.year(date_col), F.month(date_col),
                                F.dayofmonth(date_col), hour_col, F.lit(0), F.lit(0))


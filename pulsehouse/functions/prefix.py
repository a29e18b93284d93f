"""Running sums in two levels, so that no key's rows have to pass one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], block: Column, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over the key's rows up to this one, in ``order``.

    ``block`` is a function of the order columns that never falls as they rise (a date of a
    time, say) and is not NULL. Blocks are summed first (one row per key and block); the sums before each block
    come from a scan of these few rows, and the running sums inside blocks are taken per (key,
    block). A key with all rows is as many tasks as it has blocks. Keys may be NULL; NULL
    values count as nothing."""
    rows = df.withColumn("_block", block)
    sums = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(offsets, same).select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))

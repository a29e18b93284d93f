"""As-of join by merging: each event with the dimension version valid at its time.

Events and version boundaries are tagged, united and sorted once per key; the last
version is carried forward over the events behind it. The work is linear in events plus
versions, where a join on the key followed by a range test compares every event of a key
with every version of it.

A key is not one task: it is split by time range (a day, by default). What is valid when a
range begins comes from a small table first, one row per (key, range): the last boundary
inside each range that has one, carried over the ranges of the key. Its size follows the
(key, range) pairs that occur, never events or versions.

Versions of a key follow each other (as a type-2 history's do): one version at most is valid
at a time. A version that ends where no other begins leaves the key without one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NS = "timestamp_ntz"


def _boundaries(history: DataFrame, attrs: list[str], key: str) -> DataFrame:
    """k, t, v: at time t the key's version becomes v (``v.open`` false: no version). Where one
    version ends as the next begins, the beginning counts."""
    attr_of = [F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)]
    none = [F.lit(None).cast(history.schema[a].dataType).alias(f"a{i}") for i, a in enumerate(attrs)]
    begin = F.struct(F.col("dbt_valid_from").cast(_NS).alias("t"), F.struct(F.lit(True).alias("open"), *attr_of).alias("v"))
    end = F.struct(F.col("dbt_valid_to").cast(_NS).alias("t"), F.struct(F.lit(False).alias("open"), *none).alias("v"))
    rows = history.where(F.col(key).isNotNull() & F.col("dbt_valid_from").isNotNull()
                         & (F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_from") < F.col("dbt_valid_to"))))
    both = rows.select(F.col(key).alias("k"), F.explode(F.array(begin, end)).alias("b"))
    return both.select("k", "b.t", "b.v").where("t IS NOT NULL")


def _range(t: Column, grain: str) -> Column:
    return F.date_trunc(grain, t).cast(_NS)


def as_of_join(events: DataFrame, history: DataFrame, attrs: list[str], key: str = "user_id",
               ts: str = "event_ts", grain: str = "day") -> DataFrame:
    """``events`` with the ``attrs`` of the version valid at ``ts`` (valid_from <= ts < valid_to;
    NULL without one, and for events without key or time). Every event is kept once.

    ``grain`` is the time range by which a key is split: a range of the busiest key has to fit
    a task's sort, which spills."""
    out = events.columns
    clash = [a for a in attrs if a in out]
    if clash:
        raise ValueError(f"events already have {clash}")
    bounds = _boundaries(history, attrs, key).withColumn("r", _range(F.col("t"), grain))
    row = F.struct(*[F.col(f"`{c}`") for c in out])
    ev = events.select(F.col(key).alias("k"), F.col(ts).cast(_NS).alias("t"), row.alias("e"))
    timed = F.col("k").isNotNull() & F.col("t").isNotNull()
    ev_r = ev.where(timed).withColumn("r", _range(F.col("t"), grain))

    # one row per (key, range): what is valid when a range with events begins
    version = bounds.schema["v"].dataType
    last = bounds.groupBy("k", "r").agg(F.max_by(F.struct("v"), F.struct("t", F.col("v.open"))).alias("last"))
    wanted = ev_r.select("k", "r").distinct().withColumn("last", F.lit(None).cast(last.schema["last"].dataType))
    ranges = last.unionByName(wanted).groupBy("k", "r").agg(
        F.first("last", ignorenulls=True).alias("last"), F.max(F.col("last").isNull()).alias("has_events"))
    before = Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ranges.withColumn("c", F.last("last", ignorenulls=True).over(before))
               .where("has_events AND c IS NOT NULL").select("k", "r", F.col("r").alias("t"), F.col("c.v").alias("v")))

    # boundaries (carried ones first), then events, in time order within (key, range)
    no_event = F.lit(None).cast(ev.schema["e"].dataType)
    opened = F.col("v.open").cast("int") + 1
    marks = carried.select("k", "r", "t", F.lit(0).alias("o"), "v", no_event.alias("e")).unionByName(
        bounds.select("k", "r", "t", opened.alias("o"), "v", no_event.alias("e")))
    rows = marks.unionByName(ev_r.select("k", "r", "t", F.lit(3).alias("o"), F.lit(None).cast(version).alias("v"), "e"))
    upto = Window.partitionBy("k", "r").orderBy("t", "o").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("f", F.last("v", ignorenulls=True).over(upto)).where("e IS NOT NULL")
    picked = [F.col(f"f.a{i}").alias(a) for i, a in enumerate(attrs)]
    joined = found.select("e", "f").unionByName(
        ev.where(~timed).select("e", F.lit(None).cast(version).alias("f")))
    return joined.select("e.*", *picked)

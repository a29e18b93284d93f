"""As-of join by merging, against a plain look-up."""
import datetime as dt
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsehouse.operators import asof
from pulsehouse.plans import registry

HISTORY = "user_id string, plan string, size int, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz"
EVENTS = "event_id int, user_id string, event_ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def at(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


def brute(events, history):
    out = []
    for i, user, t in events:
        hit = [(p, s) for u, p, s, a, b in history if u is not None and u == user and t is not None and a is not None
               and a <= t and (b is None or t < b)]
        assert len(hit) <= 1
        out.append((i, user, t, *(hit[0] if hit else (None, None))))
    return sorted(out, key=str)


def joined(spark, events, history, **more):
    e, h = spark.createDataFrame(events, EVENTS).repartition(3), spark.createDataFrame(history, HISTORY)
    return sorted(map(tuple, asof.as_of_join(e, h, ["plan", "size"], **more).collect()), key=str)


HIST = [("a", "p1", 1, at(0), at(30)), ("a", "p2", None, at(30), at(54)), ("a", None, 3, at(60), None),   # gap 54..60
        ("b", "q", 1, at(-500), None), ("c", "r", 1, at(10), at(10)), (None, "n", 1, at(0), None),
        ("d", "s", 1, None, None), ("e", "t", 1, at(24), at(48))]
EV = [(n, u, at(h)) for n, (u, h) in enumerate(
    [(u, h) for u in ("a", "b", "c", "d", "e", "zz", None) for h in (-1, 0, 5, 24, 29, 30, 47, 48, 53, 54, 59, 60, 61, 1000, None)])]


@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_edges_gaps_and_nulls(spark, grain):
    assert joined(spark, EV + EV[:3], HIST, grain=grain) == brute(EV + EV[:3], HIST)


def test_empty_sides(spark):
    assert joined(spark, EV[:4], []) == brute(EV[:4], [])
    assert joined(spark, [], HIST) == []


def test_clashing_columns_are_refused(spark):
    e = spark.createDataFrame([(1, "a", T0, "x")], EVENTS + ", plan string")
    with pytest.raises(ValueError, match="plan"):
        asof.as_of_join(e, spark.createDataFrame(HIST, HISTORY), ["plan"])
    # working names of the join may be columns of the events
    e = spark.createDataFrame([(1, "a", T0, "x", "y", "z")], EVENTS + ", k string, v string, r string")
    assert asof.as_of_join(e, spark.createDataFrame(HIST, HISTORY), ["plan"]).first()["plan"] == "p1"


CUTS = st.lists(st.integers(0, 90), max_size=5, unique=True).map(sorted)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("abc"), st.tuples(CUTS, st.booleans()), max_size=3),
       st.lists(st.tuples(st.sampled_from("abcd"), st.integers(-3, 95)), max_size=25), st.sampled_from(["hour", "day"]))
def test_any_history_equals_the_look_up(spark, keys, visits, grain):
    history = []
    for user, (cuts, open_end) in keys.items():
        for n, (a, b) in enumerate(zip(cuts, [*cuts[1:], None])):
            if b is None and not open_end:
                continue
            history.append((user, f"{user}{n}", n, at(a), at(b)))
    events = [(i, u, at(h)) for i, (u, h) in enumerate(visits)]
    assert joined(spark, events, history, grain=grain) == brute(events, history)


def test_ten_thousand_versions_of_one_key(spark):
    """Linear in events plus versions: the join on the key would compare 400 million pairs."""
    n, m = 10_000, 40_000
    step = F.expr("INTERVAL 1 MINUTE")
    start = F.lit(T0).cast("timestamp_ntz")
    h = spark.range(n).select(F.lit("hot").alias("user_id"), F.col("id").cast("int").alias("size"),
                              (start + step * F.col("id")).alias("dbt_valid_from"),
                              F.when(F.col("id") < n - 1, start + step * (F.col("id") + 1)).alias("dbt_valid_to"))
    e = spark.range(m).select(F.col("id").cast("int").alias("event_id"), F.lit("hot").alias("user_id"),
                              (start + F.expr("INTERVAL 15 SECOND") * F.col("id")).alias("event_ts"))
    e, h = registry.materialized(e), registry.materialized(h)
    t = time.perf_counter()
    off = asof.as_of_join(e, h, ["size"]).where("size <> cast(event_id / 4 as int) OR size IS NULL").count()
    assert off == 0 and time.perf_counter() - t < 60
    plan = asof.as_of_join(e, h, ["size"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan        # nothing pairs events with versions


def test_hot_key_is_split_by_time(spark):
    e = spark.range(3000).select(F.col("id").cast("int").alias("event_id"), F.lit("hot").alias("user_id"),
                                 (F.lit(T0).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") * F.col("id")).alias("event_ts"))
    h = spark.createDataFrame([("hot", "p", 1, at(0), None)], HISTORY)
    out = asof.as_of_join(e, h, ["plan"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 3000

"""The filter of repeated keys: never a false 'unique', merges, hot ids, same Silver as the plain dedup."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import ev
from pulsehouse.operators import key_filter, silver
from pulsehouse.schemas import BRONZE
from pulsehouse.session import scratch_path


def written(df):
    path = scratch_path(df.sparkSession, "t-filter")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split(rows, key):
    return key_filter.split(rows, *key_filter.repeated(rows, key), key)


def keys_frame(spark, keys):
    return written(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(4))


def test_unique_rows_are_really_unique_and_none_is_lost(spark):
    rng = random.Random(1)
    keys = [f"id{rng.randrange(3000)}" for _ in range(4000)] + [None, None, ""]
    once, rest = split(keys_frame(spark, keys), "k")
    count = {k: keys.count(k) for k in set(keys)}
    got = [r["k"] for r in once.collect()]
    assert len(got) == len(set(got)) and all(count[k] == 1 for k in got)
    others = [r["k"] for r in rest.collect()]
    assert sorted(map(str, got + others)) == sorted(map(str, keys))
    # the filter lets few unique keys through to the shuffle
    false = sum(count[k] == 1 for k in others)
    assert false <= 0.05 * sum(n == 1 for n in count.values())


def test_a_table_too_small_only_costs_shuffles(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "MIN_WORDS", 1)
    monkeypatch.setattr(key_filter, "MAX_WORDS", 2)
    keys = [f"id{i}" for i in range(500)] + [f"id{i}" for i in range(0, 500, 2)]
    once, rest = split(keys_frame(spark, keys), "k")
    assert once.count() + rest.count() == len(keys)
    assert rest.select("k").distinct().count() >= 250


def test_tables_merge(spark):
    hashes = [spark.range(i * 100, i * 100 + 100).select(F.xxhash64("id").alias("h")) for i in range(3)]
    parts = [key_filter.table(h, 64) for h in hashes]
    whole = key_filter.table(hashes[0].union(hashes[1]).union(hashes[2]), 64)
    assert sorted(key_filter.merge_tables(*parts).collect()) == sorted(whole.collect())


def test_words_stay_within_bounds():
    assert key_filter.words_for(0) == key_filter.MIN_WORDS
    assert key_filter.words_for(10**12) == key_filter.MAX_WORDS
    for n in (1, 10**4, 10**6):
        w = key_filter.words_for(n)
        assert w & (w - 1) == 0 and (64 * w >= n * key_filter.BITS_PER_KEY or w == key_filter.MAX_WORDS)


@pytest.mark.parametrize("deterministic", [True, False])
def test_same_silver_as_the_plain_dedup(spark, deterministic, monkeypatch):
    rows = [ev(f"e{i}", latency=i % 7) for i in range(300)]
    rows += [ev(f"e{i}", latency=i % 7) for i in range(0, 300, 3)]
    rows += [ev(None), ev("e1", service=None), ev("x", ts="garbage")]
    valid = written(silver.valid(spark.createDataFrame(rows, BRONZE)))
    plain = silver.dedup(valid, deterministic)
    want = sorted(map(str, plain.collect()))
    for share in (0.0, 1.0):        # all rows aggregated at once, and the filter
        monkeypatch.setattr(silver, "FILTER_MAX_SHARE", share)
        assert sorted(map(str, silver.dedup_filtered(valid, deterministic).collect())) == want


def test_hot_id_is_counted_per_task_and_kept_once(spark):
    cold = [ev(f"c{i}") for i in range(200)]
    hot = spark.createDataFrame(cold, BRONZE).unionByName(
        spark.createDataFrame([ev("hot")], BRONZE).crossJoin(spark.range(50_000)).drop("id"))
    valid = written(silver.valid(hot).repartition(8))
    out = silver.dedup_filtered(valid)
    assert out.count() == 201
    plan = key_filter.repeated_hashes(valid, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1      # counted before the shuffle
    once, rest = split(valid, "event_id")
    assert rest.count() >= 50_000 and once.count() <= 200


def test_unique_rows_are_not_shuffled(spark):
    valid = written(silver.valid(spark.createDataFrame([ev(f"e{i}") for i in [0, *range(50)]], BRONZE)))
    once, _ = split(valid, "event_id")
    once.collect()
    plan = once._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "hashpartitioning(event_id" not in final and "SortMergeJoin" not in final and "BroadcastHashJoin" in final

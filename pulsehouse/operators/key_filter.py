"""A filter of repeated keys, so that a dedup need not move rows whose key occurs once.

Only the rows' 64-bit key hashes are counted across the cluster (16 bytes a row after
map-side counting, instead of the row). Hashes that occur more than once set bits in
a table of 64-bit words, by bit aggregation; the table tells which rows *may* have a
twin:

* a row whose bits are not all set is surely the only one of its key;
* any other row goes through the aggregation on its key, as before.

A key that is falsely taken for a repeated one only costs moving its row. Tables of
parts of the data merge by OR of words plus the keys counted across parts
(:func:`merge_tables`); the words have a fixed upper number, so the table may be broadcast
whatever the data's size.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

BITS_PER_KEY = 16
PROBES = 3                     # bits set per key, all in one word
MIN_WORDS, MAX_WORDS = 1 << 10, 1 << 20   # 1 M words: 8 MB of bits, some 32 MB as a broadcast table


def key_hash(*keys: str) -> Column:
    return F.xxhash64(*keys)


def repeated_hashes(rows: DataFrame, *keys: str) -> DataFrame:
    """``h``: hashes of keys that more than one row has. Counted per task first, so a key with
    millions of copies is one row per task."""
    return (rows.groupBy(key_hash(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("h"))


def _word(h: Column, words: int) -> Column:
    return h.bitwiseAND(F.lit(words - 1))


def _bits(h: Column) -> Column:
    """The key's bits in its word: PROBES groups of 6 bits from the upper half of the hash."""
    out = F.lit(0).cast("bigint")
    for i in range(PROBES):
        at = F.shiftrightunsigned(h, 32 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return out


def words_for(n_keys: int) -> int:
    """Words for so many repeated keys: a power of two within the fixed bounds."""
    wanted = max(1, n_keys * BITS_PER_KEY // 64)
    return min(MAX_WORDS, max(MIN_WORDS, 1 << (wanted - 1).bit_length()))


def table(hashes: DataFrame, words: int) -> DataFrame:
    """word, bits: at most ``words`` rows (``hashes``: column h)."""
    return hashes.groupBy(_word(F.col("h"), words).alias("word")).agg(F.bit_or(_bits(F.col("h"))).alias("bits"))


def merge_tables(*tables: DataFrame) -> DataFrame:
    """One table that answers 'may be repeated' for every key any of them does (same number of words)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def flagged(rows: DataFrame, filter_table: DataFrame, words: int, *keys: str, name: str = "may_repeat") -> DataFrame:
    """The rows with a flag; the table has at most ``words`` rows, so it is broadcast."""
    h = key_hash(*keys)
    looked = F.broadcast(filter_table.select(F.col("word").alias("_w"), F.col("bits").alias("_b")))
    hit = F.col("_b").isNotNull() & (F.col("_b").bitwiseAND(_bits(h)) == _bits(h))
    return (rows.join(looked, _word(h, words) == F.col("_w"), "left")
            .withColumn(name, hit).drop("_w", "_b"))


def repeated(rows: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """:func:`repeated_hashes`, written once, and their number."""
    spark = rows.sparkSession
    path = scratch_path(spark, "repeated-keys")
    repeated_hashes(rows, *keys).write.parquet(path)
    hashes = spark.read.schema("h bigint").parquet(path)
    return hashes, hashes.count()


def split(rows: DataFrame, hashes: DataFrame, n: int, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key surely occurs once, all other rows), by the ``n`` repeated hashes. Both
    read ``rows``: give a written table. NULL keys count as equal keys."""
    words = words_for(n)
    marked = flagged(rows, table(hashes, words), words, *keys)
    return marked.where(~F.col("may_repeat")).drop("may_repeat"), marked.where("may_repeat").drop("may_repeat")

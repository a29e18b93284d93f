"""Document fingerprints by one-permutation MinHash (DataFrame functions only).

Each word shingle is hashed once; the hash's top bits choose one of ``BINS``
bins and each bin keeps its smallest hash. Empty bins are filled by optimal
densification: bin i probes bins in its own pseudo-random order and copies the
first one that is not empty. Only the low ``BITS`` bits of each bin are kept,
packed as hex digits; likeness corrects for chance agreement of those bits.

Defined cases: NULL text counts as empty; a text with fewer than five words is
one shingle (its whole word sequence); a text without words has the empty
fingerprint ``''``, whose likeness is 1 to itself and 0 to any other.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, let, shuffle_partitions

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 4          # one hex digit per bin
PROBES = 6        # probes written out before the full search
_SIGN = -(1 << 63)


def _probe_order(i: int) -> list[int]:
    """The order in which empty bin i tries the other bins: a permutation from an
    integer hash of (i, candidate), so every non-empty bin is reached."""
    def mix(x: int) -> int:
        x = (x * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) & (2**64 - 1)
        x ^= x >> 29
        x = (x * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        return x ^ (x >> 32)
    return sorted((b for b in range(BINS) if b != i), key=lambda b: mix(i * BINS + b))


def shingle_hashes(text: Column) -> Column:
    """One 64-bit hash per word shingle of the lower-cased text (repeats included)."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")

    def hashes(h: Column) -> Column:
        rolled = F.transform(F.sequence(F.lit(1), F.size(h) - (SHINGLE - 1)),
                             lambda i: F.xxhash64(F.slice(h, i, SHINGLE)))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < SHINGLE, F.array(F.xxhash64(h))).otherwise(rolled))
    return let(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def _dense_minima(hashes: Column) -> Column:
    """Per bin its smallest hash, or NULL: one sentinel per bin joins the sort, so
    exactly BINS first-of-bin entries remain, in bin order."""
    shift = 64 - BIN_BITS
    top = [((i << shift) | ((1 << shift) - 1)) for i in range(BINS)]
    sentinels = F.array(*[F.lit(v - (1 << 64) if v >= 1 << 63 else v) for v in top])
    low = (1 << shift) - 1

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, k: (k == 0) | (
            F.shiftright(F.get(s, k - 1), shift) != F.shiftright(x, shift)))

    def ordered(f: Column) -> Column:   # signed order puts the upper half of the bins first
        half = BINS // 2
        joined = F.concat(F.slice(f, half + 1, half), F.slice(f, 1, half))
        return F.transform(joined, lambda x: F.when(x.bitwiseAND(F.lit(low)) != F.lit(low), x))
    return let(F.sort_array(F.concat(hashes, sentinels)), lambda s: let(firsts(s), ordered))


def fingerprint(text: Column) -> Column:
    """Hex string of BINS digits, '' for a text without words."""
    orders = [_probe_order(i) for i in range(BINS)]
    probes = [F.array(*[F.lit(o[p]) for o in orders]) for p in range(PROBES)]

    def filled(v: Column) -> Column:
        return F.filter(F.transform(v, lambda x, b: F.when(x.isNotNull(), b)), lambda b: b.isNotNull())

    def fill(v: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            tries = [F.get(v, F.get(p, i)) for p in probes]
            # all written-out probes empty: go on in the order of a hash of (bin, candidate)
            last = F.array_min(F.transform(filled(v), lambda b: F.struct(
                F.xxhash64(i, b).alias("h"), F.get(v, b).alias("v"))))["v"]
            return F.coalesce(x, *tries, last)
        digits = F.transform(v, lambda x, i: F.substring(
            F.lit("0123456789abcdef"), value(x, i).bitwiseAND(F.lit(15)).cast("int") + 1, 1))
        return F.array_join(digits, "")

    def of(hashes: Column) -> Column:
        return F.when(F.size(hashes) == 0, F.lit("")).otherwise(let(_dense_minima(hashes), fill))
    return let(shingle_hashes(text), of)


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected share of agreeing bins, between 0 and 1."""
    chance = 1.0 / (1 << BITS)
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int")),
                       F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    corrected = (same / F.lit(float(BINS)) - chance) / (1.0 - chance)
    return (F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected))))


def with_next(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows it in descending
    order of ``key`` (after the last: the first).

    Rows are dealt to key ranges whose upper bounds are quantiles, hence keys
    that occur. A range is one window partition; the row that follows its last
    row is the head of the range below, and that head's key is the bound, so
    it is copied into the range above before the one shuffle. NULL keys count
    as the smallest; rows of equal key are ordered by their content hash.
    """
    spark = docs.sparkSession
    k = F.coalesce(F.col(key), F.lit(-(2**63)))
    n = 2 * shuffle_partitions(spark)
    bounds = docs.select(k.alias("k")).agg(F.percentile_approx(
        "k", [(i + 1) / n for i in range(n)], 10 * n)).first()[0]
    bounds = sorted(set(bounds or []))
    if not bounds:
        return docs.withColumns({f"next_{c}": F.lit(None).cast(docs.schema[c].dataType) for c in columns})
    table = F.array(*[F.lit(b) for b in bounds])
    m = len(bounds)
    steps = max(1, math.ceil(math.log2(m + 1)))
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0).alias("lo"), F.lit(m - 1).alias("hi")),
        lambda s, _: let(F.floor((s["lo"] + s["hi"]) / 2).cast("int"), lambda mid: F.when(
            F.get(table, mid) < F.col("_k"), F.struct(F.least(mid + 1, F.lit(m - 1)).alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))), lambda s: s["hi"])
    rows = docs.withColumn("_k", k).withColumn("_range", found)
    head = F.col("_k") == F.get(table, F.col("_range"))
    above = ((F.col("_range") + 1) % m).cast("int")
    copies = F.when(head, F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("tail")),
                                  F.struct(above.alias("r"), F.lit(1).alias("tail")))
                    ).otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("tail"))))
    rows = rows.withColumn("_at", F.explode(copies))
    w = Window.partitionBy("_at.r").orderBy(F.col("_at.tail"), F.col("_k").desc(),
                                            F.xxhash64(*columns))
    nxt = {f"next_{c}": F.lead(c).over(w) for c in columns}
    return rows.withColumns(nxt).where(F.col("_at.tail") == 0).drop("_k", "_range", "_at")


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by the start of the following text."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut),
                    F.substring(following, F.lit(1), cut))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint of every document."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "fingerprint", fingerprint(F.col("text")))


def query(spark, docs: DataFrame) -> DataFrame:
    rows = with_next(fingerprints(docs), "doc_id", ["text", "fingerprint"])
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))

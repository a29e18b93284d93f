"""Quality classifier: hashed word n-gram logistic regression learned by FTRL-proximal.

Features of a text are hashed n-grams of its words (1 and 2) and of the words'
shapes (1 to 3; a shape keeps what characters a word has, not which letters, and
notes whether it repeats the word before). A document's score is one sparse dot
product: the mean weight of its n-grams' buckets times the square root of their
number, through the logistic function.

Learning: at most ``TRAIN_ROWS`` labelled documents, those of least id hash;
their features are hashed in parallel and one task runs the updates over them
in a fixed order, so reruns agree. Scoring reads every whole text.

Defined cases: NULL text is empty; a text without words has only the bias, so
a fixed score; labels that are NULL are ignored; without labels every score is
0.5.
"""
from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language_id import crc32_of

BUCKETS = 1 << 18
TRAIN_ROWS = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.15, 1.0, 0.05, 1.0
THRESHOLD = 0.3
CACHE_ENTRIES = 400_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUNS = re.compile(r"(?P<u>[A-ZÀ-ÖØ-Þ]+)|(?P<l>[a-zß-öø-ÿ]+)|(?P<d>[0-9]+)")
_WORDS: dict[str, tuple[int, int]] = {}


def _word(w: str) -> tuple[int, int]:
    """(hash of the word, hash of its shape), kept per worker."""
    shape = _RUNS.sub(lambda m: {"u": "A" if len(m[0]) < 2 else "AA", "l": "a", "d": "0"}[m.lastgroup], w)
    h = zlib.crc32(w.encode("utf-8", "surrogatepass")), zlib.crc32(shape.encode("utf-8", "surrogatepass"), 77)
    if len(_WORDS) > CACHE_ENTRIES:
        _WORDS.clear()
    _WORDS[w] = h
    return h


def _mix(*parts) -> np.ndarray:
    x = np.full(1, 0x9E3779B97F4A7C15, np.uint64)   # an array: its products wrap silently
    for p in parts:
        x = (x ^ p) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
    return (x & np.uint64(BUCKETS - 1)).astype(np.uint32)


def features(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of the text, repeats included."""
    words = _WORD.findall(text or "")
    if not words:
        return np.empty(0, np.uint32)
    known = _WORDS.get
    h = np.array([known(w) or _word(w) for w in words], np.uint64)
    w, s = h[:, 0], h[:, 1].copy()
    s[1:] ^= (w[1:] == w[:-1]).astype(np.uint64) << np.uint64(40)
    return np.concatenate([_mix(np.uint64(1), w), _mix(np.uint64(2), w[:-1], w[1:]), _mix(np.uint64(3), s),
                           _mix(np.uint64(4), s[:-1], s[1:]), _mix(np.uint64(5), s[:-2], s[1:-1], s[2:])])


def ftrl(rows: list[np.ndarray], labels: list[int]) -> np.ndarray:
    """Weights (the last is the bias) after follow-the-regularised-leader updates."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)
    data = []
    for r in rows:
        at, k = np.unique(r, return_counts=True)
        data.append((np.append(at.astype(np.int64), BUCKETS), np.append(k / np.sqrt(max(1, len(r))), 1.0)))
    for _ in range(EPOCHS):
        for (at, x), y in zip(data, labels):
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    return weights(z, n)


def learn(docs: DataFrame, labels: DataFrame, label: str, eligible: Column) -> np.ndarray:
    """Weights from the labelled documents for which ``eligible`` holds."""
    known = labels.where(eligible & F.col(label).isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))
    known = known.orderBy("h", "doc_id", "y").limit(TRAIN_ROWS)
    # one document (of least hash) per labelled id, however many rows share it
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "h", "y").agg(
        F.min(F.struct(F.xxhash64("text").alias("of"), "text")).alias("d")).select("h", "y", "d.text")

    def hashed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [features(t).tobytes() for t in b.column(2).to_pylist()], pa.binary())], ["h", "y", "f"])

    def train(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("y", "ascending")])
        rows = [np.frombuffer(x, np.uint32) for x in table.column("f").to_pylist()]
        w = ftrl(rows, table.column("y").to_pylist())
        return pa.table({"w": pa.array([w.astype("<f8").tobytes()], pa.binary())})
    rows = sample.mapInArrow(hashed, "h bigint, y int, f binary").withColumn("all", F.lit(0))   # TRAIN_ROWS at most
    out = rows.groupBy("all").applyInArrow(train, "w binary").collect()
    return np.frombuffer(out[0]["w"], "<f8") if out else np.zeros(BUCKETS + 1)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns + score for every document."""
    schema, n, w = docs.select(*keep).schema, len(keep), weights.astype(np.float32)

    def one(text):
        f = features(text)
        z = float(w[BUCKETS]) + (float(w[f].sum(dtype=np.float64)) / len(f) ** 0.5 if len(f) else 0.0)
        return 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, z))))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(
                [one(t) for t in b.column(n).to_pylist()], pa.float64())], [*keep, "score"])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["score double"])
    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(run, ddl)


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = F.coalesce(crc32_of("doc_id") % 5 == 0, F.lit(False))
    weights = learn(docs, labels, "quality", ~held_out)
    rows = score(docs.select("doc_id", "text").withColumn("held_out", held_out), weights, ["doc_id", "held_out"])
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

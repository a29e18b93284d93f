"""Toxicity by a classifier chain.

The labels have one flag, so the categories are found in the labelled sample:
*markers* (words and word beginnings that toxic documents have and others do
not) are grouped by their occurrence in the same documents, and the
``CATEGORIES`` groups found in most toxic documents are the categories. A
document belongs to a category if it is labelled toxic and has one of the
group's markers. The chain predicts the categories one after the other and
``toxic`` itself last. Each link is a logistic model over the document's
features and the probabilities of all links before it; while learning, those
probabilities are out-of-fold predictions (``FOLDS`` folds by id hash), so a
link never sees what an earlier one remembers of its own training rows. For
scoring, every link is fitted once more on all rows.

Learning uses at most ``TRAIN_ROWS`` labelled documents, those of least id
hash, in one task; features are taken in parallel. Scoring reads every whole
text.

Defined cases: NULL or blank text has no features and gets the models' base
rates; NULL labels are ignored; without a labelled toxic document all
probabilities are 0.
"""
from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = 4
FOLDS = 5
TRAIN_ROWS = 6000
MAX_FEATURES = 4096      # those most associated with the flag
MIN_ROWS = 4             # documents a feature must be in
PREFIXES = (4, 5, 6)
STEPS, RATE, L2 = 150, 0.3, 1e-4
CACHE_ENTRIES = 400_000
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings (marked by a trailing *)."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


def text_features(text: str | None) -> list[str]:
    """Features of the text's distinct words; a beginning that several of them share counts
    once more, marked **."""
    found: set[str] = set()
    for w in set(_WORD.findall((text or "").lower())):
        for f in word_features(w):
            found.add(f + "*" if f in found else f)
    return sorted(found)


class Rows:
    """Sparse presence features of the training rows."""

    def __init__(self, rows: list[np.ndarray], size: int):
        self.at = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n, self.size = len(rows), size

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, g[self.row], self.size)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit(x: Rows, more: np.ndarray, y: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression on the rows ``use`` marks: weights of the sparse features, and of
    the dense ones (probabilities of earlier links, then the bias)."""
    w, v = np.zeros(x.size), np.zeros(more.shape[1] + 1)
    dense = np.hstack([more, np.ones((x.n, 1))])
    n = max(1, int(use.sum()))
    m = [np.zeros_like(w), np.zeros_like(v)]
    s = [np.zeros_like(w), np.zeros_like(v)]
    for t in range(1, STEPS + 1):
        g = np.where(use, sigmoid(x.dot(w) + dense @ v) - y, 0.0) / n
        grads = [x.back(g) + L2 * w, dense.T @ g]
        for i, (p, d) in enumerate(zip((w, v), grads)):
            m[i] = 0.9 * m[i] + 0.1 * d
            s[i] = 0.99 * s[i] + 0.01 * d * d
            p -= RATE * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.99**t)) + 1e-8)
    return w, v


def marker_groups(present: np.ndarray, names: list[str], toxic: np.ndarray, clean: np.ndarray) -> list[list[int]]:
    """Groups of marker features. A marker is in at least ``MIN_ROWS`` toxic documents and there
    50 times as often as in others; it joins the first group more than a fifth of whose
    documents it shares, else it starts one. The largest groups, by toxic documents, stay."""
    t, c = toxic.mean(1) if toxic.size else 0, clean.mean(1) if clean.size else 0
    marks = [i for i in present if toxic[i].sum() >= MIN_ROWS and t[i] > 50 * c[i]]
    marks.sort(key=lambda i: (-toxic[i].sum(), names[i]))
    groups: list[tuple[list[int], np.ndarray]] = []
    for i in marks:
        for members, docs in groups:
            if 5 * (toxic[i] & docs).sum() > min(toxic[i].sum(), docs.sum()):
                members.append(i)
                docs |= toxic[i]
                break
        else:
            groups.append(([i], toxic[i].copy()))
    groups.sort(key=lambda g: -g[1].sum())
    return [g for g, _ in groups[:CATEGORIES]]


def learn_chain(rows: list[list[str]], flags: np.ndarray, fold: np.ndarray) -> dict:
    """The chain from the feature lists of the training rows (all in memory: TRAIN_ROWS at most)."""
    if not flags.any():
        return {"features": [], "links": [], "markers": []}
    count: dict[str, list[int]] = {}
    for r, y in zip(rows, flags):
        for f in r:
            count.setdefault(f, [0, 0])[int(y)] += 1
    pos, neg = int(flags.sum()), int((~flags).sum())

    def gain(f):   # signed chi-square of presence against the flag
        a, b = count[f][1], count[f][0]
        e = (a + b) * pos / (pos + neg)
        return -((a - e) ** 2 / e + (a - e) ** 2 / max(1e-9, a + b - e))
    names = sorted((f for f in count if sum(count[f]) >= MIN_ROWS), key=lambda f: (gain(f), f))[:MAX_FEATURES]
    number = {f: i for i, f in enumerate(names)}
    at = [np.array(sorted(number[f] for f in r if f in number), np.int64) for r in rows]
    x = Rows(at, len(names))
    has = np.zeros((len(names), len(rows)), bool)
    has[x.at, x.row] = True
    groups = marker_groups(np.arange(len(names)), names, has[:, flags], has[:, ~flags])
    targets = [flags & has[g].any(0) for g in groups] + [flags]
    chain, oof = [], np.zeros((len(rows), 0))
    for y in targets:
        y = y.astype(float)
        p = np.zeros(len(rows))
        for k in range(FOLDS):
            w, v = fit(x, oof, y, fold != k)
            out = fold == k
            p[out] = sigmoid(x.dot(w) + oof @ v[:-1] + v[-1])[out]
        w, v = fit(x, oof, y, np.ones(len(rows), bool))
        chain.append([w.tolist(), v.tolist()])
        oof = np.hstack([oof, p[:, None]])
    return {"features": names, "links": chain, "markers": [[names[i] for i in g] for g in groups]}


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    known = labels.where(F.col("toxic").isNotNull()).select(
        "doc_id", F.col("toxic").cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))
    known = known.orderBy("h", "doc_id", "y").limit(TRAIN_ROWS)
    # one document (of least hash) per labelled id, however many rows share it
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "h", "y").agg(
        F.min(F.struct(F.xxhash64("text").alias("of"), "text")).alias("d")).select("h", "y", "d.text")

    def take(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [text_features(t) for t in b.column(2).to_pylist()], pa.list_(pa.string()))], ["h", "y", "f"])

    def train(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("y", "ascending")])
        h = np.asarray(table.column("h"), np.int64)
        model = learn_chain(table.column("f").to_pylist(), np.asarray(table.column("y")) == 1, h % FOLDS)
        return pa.table({"model": pa.array([json.dumps(model)])})
    rows = sample.mapInArrow(take, "h bigint, y int, f array<string>").withColumn("all", F.lit(0))
    out = rows.groupBy("all").applyInArrow(train, "model string").collect()
    return json.loads(out[0]["model"]) if out else {"features": [], "links": [], "markers": []}


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``categories`` (probability per category, in chain order), ``toxic_score``."""
    number = {f: i for i, f in enumerate(model["features"])}
    links = [(np.array(w), np.array(v)) for w, v in model["links"]]
    schema, n = docs.select(*keep).schema, len(keep)

    def run(batches):
        known: dict[str, tuple] = {}   # word -> (feature, its number, number if shared) of those in the model

        def of(word):
            if len(known) > CACHE_ENTRIES:
                known.clear()
            known[word] = hit = tuple((f, number.get(f), number.get(f + "*")) for f in word_features(word)
                                      if f in number or f + "*" in number)
            return hit

        def chain(text):
            seen: set[str] = set()
            found: set[int | None] = {None}
            for word in set(_WORD.findall((text or "").lower())):
                hit = known.get(word)
                for f, one, several in of(word) if hit is None else hit:
                    found.add(several if f in seen else one)
                    seen.add(f)
            at, p = np.array(sorted(found - {None}), np.int64), []
            for w, v in links:
                p.append(float(sigmoid(w[at].sum() + np.dot(p, v[:-1]) + v[-1])))
            return p or [0.0]
        for b in batches:
            all_p = [chain(t) for t in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([p[:-1] for p in all_p], pa.list_(pa.float64())),
                 pa.array([p[-1] for p in all_p], pa.float64())], [*keep, "categories", "toxic_score"])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
                    + ["categories array<double>", "toxic_score double"])
    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(run, ddl)


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, categories, toxic_score, toxic (1 if the score is at least THRESHOLD)."""
    rows = score(docs, learn(docs, labels), ["doc_id"])
    return rows.withColumn("toxic", (F.col("toxic_score") >= THRESHOLD).cast("int"))

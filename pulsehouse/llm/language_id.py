"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``PROFILE`` most frequent letter n-grams (n = 1 to
3, lower case, words padded by a blank), most frequent first, ties by code
points. A document gets the language whose profile is nearest by out-of-place
distance: the sum, over the document's profile, of how far each n-gram's rank
is from its rank in the language's profile (``PROFILE`` where it is missing).

Learning: at most ``TRAIN_PER_LANGUAGE`` documents a language and
``TRAIN_TOTAL`` in all, those of least id hash; their n-grams are counted in
tasks and summed by Spark. Prediction reads every whole text.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0,
as is every text when nothing could be learned. The score is 1 - d1/d2 of the
two least distances (d2 = the greatest possible distance if there is one
language), so 0 means a tie; ties go to the first language in code-point order.
"""
from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300
TRAIN_PER_LANGUAGE = 1500
TRAIN_TOTAL = 20_000
UNKNOWN = "und"
_BLANK = 32


def crc32_of(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary"))


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, repeats included (21 bits a character)."""
    if not text:
        return np.empty(0, np.uint64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    low = c < 1 << 16
    letter = np.zeros(len(c), bool)
    letter[low] = _letters()[c[low].astype(np.int64)]
    if not low.all():
        letter[~low] = [chr(x).isalpha() for x in c[~low]]
    if not letter.any():
        return np.empty(0, np.uint64)
    c = np.concatenate([[_BLANK], np.where(letter, c, _BLANK), [_BLANK]]).astype(np.uint64)
    c = c[np.append(True, (c[1:] != _BLANK) | (c[:-1] != _BLANK))]     # one blank between words
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = ((two[:-1] << np.uint64(21)) | c[2:])[c[1:-1] != _BLANK]
    return np.concatenate([c[c != _BLANK], two, three])


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first; codes come in ascending order."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Language profiles laid out for lookup: per language sorted codes and their ranks."""

    def __init__(self, by_language: dict[str, np.ndarray]):
        self.names = sorted(by_language, key=lambda s: s.encode())
        self.table = []
        for name in self.names:
            order = np.argsort(by_language[name])
            self.table.append((by_language[name][order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        g = grams(text)
        if not len(g) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(*np.unique(g, return_counts=True))
        place = np.arange(len(own))
        far = []
        for codes, rank in self.table:
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            far.append(int(np.where(codes[at] == own, np.abs(rank[at] - place), PROFILE).sum()))
        best = int(np.argmin(far))
        second = min([far[i] for i in range(len(far)) if i != best], default=PROFILE * len(own))
        return self.names[best], (1.0 - far[best] / second if second else 0.0)


def learn(docs: DataFrame, eligible: Column) -> Profiles:
    """Profiles from (doc_id, text, lang) rows for which ``eligible`` holds and lang is set."""
    rows = docs.where(eligible & F.col("lang").isNotNull())
    pick = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # a window over one language sees about three times what it keeps, however large the language
    share = {r["lang"]: 3.0 * TRAIN_PER_LANGUAGE / r["n"] for r in
             ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}      # one row a language
    if not share:
        return Profiles({})
    place = (F.col("h") / 2.0**64) + 0.5
    ids = ids.where(place < F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang")))
    ids = (ids.withColumn("nth", F.row_number().over(pick)).where(F.col("nth") <= TRAIN_PER_LANGUAGE)
           .orderBy("nth", "h", "doc_id").limit(TRAIN_TOTAL).select("doc_id").distinct())
    sample = rows.join(F.broadcast(ids), "doc_id").select("lang", "text")   # at most TRAIN_TOTAL ids

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(grams(text))
            for lang, parts in by_lang.items():
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                old = total.get(lang, (codes[:0], n[:0]))
                both, at = np.unique(np.concatenate([old[0], codes]), return_inverse=True)
                total[lang] = both, np.bincount(at, np.concatenate([old[1], n]), len(both)).astype(np.int64)
        for lang, (codes, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()),
                                              pa.array(codes.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])
    counts = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")))
    out: dict[str, list[tuple[int, int]]] = {}
    for r in top.where(F.col("rank") <= PROFILE).select("lang", "rank", "gram").collect():   # PROFILE rows a language
        out.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return Profiles({k: np.array([g for _, g in sorted(v)], np.uint64) for k, v in out.items()})


def predict(docs: DataFrame, profiles: Profiles, keep: list[str]) -> DataFrame:
    """``keep`` columns + lang_pred, score for every document."""
    schema = docs.select(*keep).schema
    n = len(keep)

    def run(batches):
        for b in batches:
            found = [profiles.predict(t) for t in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], [*keep, "lang_pred", "score"])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["lang_pred string", "score double"])
    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(run, ddl)


def query(spark, docs: DataFrame) -> DataFrame:
    held_out = F.coalesce(crc32_of("doc_id") % 4 == 2, F.lit(False))
    rows = docs.select("doc_id", "text", "lang")
    profiles = learn(rows, ~held_out)
    return predict(rows.withColumn("held_out", held_out), profiles, ["doc_id", "held_out"])

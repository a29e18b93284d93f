"""Importance resampling towards a target: bag-of-features gains, exact cut by weighted medians.

A word is a run of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII;
features are all runs of 1 to 3 consecutive words, hashed to ``BUCKETS`` by crc32 of
their bytes. A bucket's gain compares its share in the target texts with its share in
the documents; a document's weight is the sum of its features' gains, and a Gumbel
draw from its doc_id makes the score. The share of eligible documents with the highest
scores is drawn.

Features are hashed in numpy without making their strings: crc32 of a joined string
follows from the crc32 of its parts, so one table per word length moves a hash past a
word. The scores are then looked up in the array of gains.

The cut is a selection, not a sort: each partition reports the median of its
remaining keys, the median of these weighted by the remaining sizes becomes the pivot,
and one pass counts the keys on both sides of it. At least a quarter of the remaining
keys falls away each time, until the key of the last winner is known. Only winners are
sorted, in ranges.

Defined cases: a NULL text has no words, hence weight 0 (its score is the draw);
repeated rows and equal doc_ids are documents of their own, ties beyond doc_id go by
the row's place in the scored table; a NULL doc_id draws as an empty one and comes
after all others of its score. Without target texts all gains follow from T = 0.
Texts of any length are read whole; other columns are not read.
"""
from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, written

BUCKETS = 10_000
SEED = 42
MIN_WORDS = 20
SHARE = (5, 100)
LONG = 64                 # longer words are hashed one by one
PIECE_BYTES = 1 << 20     # text hashed in one numpy pass; longer texts go in pieces
SHRINK = 16               # survivors are written anew once so many times fewer
SCORED = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, row bigint"

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_CLASS = np.zeros(256, bool)
_CLASS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _byte_row() -> np.ndarray:
    """The reflected crc32 table: a byte shifted out of the hash, zero shifted in."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & np.uint32(1), np.uint32(0xEDB88320) ^ (row >> np.uint32(1)), row >> np.uint32(1))
    return row


def _tables() -> np.ndarray:
    """[length, byte of the hash, its value] -> what that byte becomes past ``length`` zero bytes."""
    out = np.zeros((LONG + 2, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, LONG + 2):
        prev = out[n - 1]
        out[n] = (prev >> np.uint32(8)) ^ _CRC_ROW[prev & np.uint32(0xFF)]
    return out


_CRC_ROW = _byte_row()
_PAST = _tables()


def _move(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The hashes moved past n bytes each: by table up to LONG + 1, longer ones one by one."""
    now = np.minimum(n, LONG + 1)
    out = (_PAST[now, 0, crc & 0xFF] ^ _PAST[now, 1, (crc >> np.uint32(8)) & 0xFF]
           ^ _PAST[now, 2, (crc >> np.uint32(16)) & 0xFF] ^ _PAST[now, 3, crc >> np.uint32(24)])
    for i in np.flatnonzero(n > LONG + 1).tolist():
        out[i] = zlib.crc32(bytes(int(n[i])), int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


_SPACE = np.uint32(zlib.crc32(b" "))


def pieces(raw: bytes, size: int | None = None) -> list[tuple[bytes, int]]:
    """A text cut between words, with the number of words (up to two) that a piece repeats
    from the one before, so that runs of words across a cut are whole in one piece."""
    size = size or PIECE_BYTES
    out, start, cut, skip = [], 0, 0, 0
    while len(raw) - cut > size:
        gap = _GAP.search(raw, cut + size)
        if not gap:
            break
        cut = gap.start()
        out.append((raw[start:cut], skip))
        back = 1 << 10
        while True:                                   # the last two words before the cut
            words = [m.start() for m in _WORD.finditer(raw, max(start, cut - back), cut)]
            if len(words) > 2 or cut - back <= start:
                break
            back *= 8
        words = words[-2:]
        start, skip = (words[0], len(words)) if words else (cut, 0)
    return [*out, (raw[start:], skip)]


def features(data: np.ndarray, starts: np.ndarray, skip: np.ndarray):
    """Feature buckets of texts laid end to end (bytes; where each text starts; how many
    leading words, two at most, only serve the features that go on behind them).

    (words per text, features per text, buckets, text of each bucket).
    """
    n_texts = len(starts)
    low = _LOWER[data]
    inside = _CLASS[low]
    linked = np.append(inside, False) & np.append(False, inside)   # byte i goes on with the word of byte i - 1
    linked[starts] = False                                         # texts never join
    begin = np.flatnonzero(inside & ~linked[:-1])
    end = np.flatnonzero(inside & ~linked[1:]) + 1
    size = end - begin
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    todo = np.flatnonzero(size <= LONG)
    for k in range(LONG):
        todo = todo[size[todo] > k]
        if not len(todo):
            break
        c = crc[todo]
        crc[todo] = _CRC_ROW[(c ^ low[begin[todo] + k]) & 0xFF] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG):
        crc[i] = zlib.crc32(low[begin[i]:end[i]])
    owner = np.searchsorted(starts, begin, "right") - 1
    joined = _move(np.full(len(crc), _SPACE, np.uint32), size) ^ crc          # " " + word
    two = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = _move(crc[two], size[two + 1] + 1) ^ joined[two + 1]
    three = np.flatnonzero(owner[2:] == owner[:-2])
    triples = _move(pairs[np.searchsorted(two, three)], size[three + 2] + 1) ^ joined[three + 2]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    own = np.flatnonzero(place >= skip[owner])
    last = np.concatenate([own, two + 1, three + 2])              # a feature counts where its last word does
    hashed = np.concatenate([crc[own], pairs, triples])
    counted = place[last] >= skip[owner[last]]
    whose = owner[last[counted]]
    return (np.bincount(owner[own], minlength=n_texts), np.bincount(whose, minlength=n_texts),
            hashed[counted] % np.uint32(BUCKETS), whose)


def _hashed(batch: pa.RecordBatch):
    """:func:`features` of a batch's texts (column 1) in blocks of about PIECE_BYTES, by row."""
    todo, held = [], 0

    def block():
        raw = [r + b" " for _, r, _ in todo]       # the blank keeps an empty last text inside the bytes
        sizes = np.array([len(r) for r in raw], np.int64)
        words, n, hashed, whose = features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes,
                                           np.array([k for _, _, k in todo], np.int64))
        row = np.array([i for i, _, _ in todo], np.int64)
        return row, words, n, hashed, row[whose]
    for i, text in enumerate(batch.column(1).to_pylist()):
        for raw, skip in pieces(text.encode()) if text else []:
            todo.append((i, raw, skip))
            held += len(raw)
            if held >= PIECE_BYTES:
                yield block()
                todo, held = [], 0
    if todo:
        yield block()


def _texts(docs: DataFrame) -> DataFrame:
    key = F.col("doc_id").cast("bigint") if "doc_id" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(key.alias("doc_id"), F.col("text").cast("string"))


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Features per bucket over all texts; tasks count before the shuffle, at most BUCKETS rows come back."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for s in slices(batches, 1):
            for _, _, _, hashed, _ in _hashed(s):
                total += np.bincount(hashed, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["bucket", "n"])
    rows = _texts(docs).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain per bucket, in thousandths of a natural logarithm."""
    big_s, big_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * big_s / ((s + 1.0) * big_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def draw(doc_id: int | None) -> int:
    """The Gumbel part of a score, from the doc_id."""
    key = f"{SEED}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``SCORED``: every document's figures; ``row`` is its place in this run's partitions
    (write the frame before the column is used)."""
    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for s in slices(batches, 1):
            words, n, weight = np.zeros((3, s.num_rows), np.int64)
            for row_of, w, k, hashed, whose in _hashed(s):
                np.add.at(words, row_of, w)
                np.add.at(n, row_of, k)
                np.add.at(weight, whose, gain[hashed])
            drawn = np.array([draw(k) for k in s.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [s.column(0), *[pa.array(x, pa.int64()) for x in (
                    words, n, weight, weight + drawn, np.arange(row, row + s.num_rows))]],
                [c.split()[0] for c in SCORED.split(", ")])
            row += s.num_rows
    return _texts(docs).mapInArrow(run, SCORED)


# Keys in drawing order (best first): score falling, doc_id rising with NULL last, row rising.
_KEY = ["a", "b", "c", "d"]


def _keyed(rows: DataFrame) -> DataFrame:
    """The rows with ascending integer keys; a smaller key is drawn earlier."""
    return rows.withColumns({"a": -F.col("score"), "b": F.col("doc_id").isNull().cast("bigint"),
                             "c": F.coalesce("doc_id", F.lit(0)).cast("bigint"), "d": F.col("row")})


def _below(bound: tuple):
    """Column condition: key up to the bound."""
    names = [F.col(c) for c in _KEY]
    out = names[-1] <= F.lit(bound[-1])
    for col, v in zip(names[-2::-1], bound[-2::-1]):
        out = (col < F.lit(v)) | ((col == F.lit(v)) & out)
    return out


def _median(keys: np.ndarray) -> np.ndarray:
    """The lower median of key rows: selection by one column after the other, without a sort."""
    rank = (len(keys) - 1) // 2
    for k in range(keys.shape[1]):
        col = keys[:, k]
        value = np.partition(col, rank)[rank]
        rank -= int((col < value).sum())
        keys = keys[col == value]
    return keys[rank]


def _report(keys: DataFrame, pivot: tuple | None) -> list[list[tuple[int, tuple]]]:
    """Per partition and side of the pivot (up to it, after it): remaining size and median."""
    def run(batches):
        held = [np.column_stack([np.asarray(c, np.int64) for c in b.columns]) for b in batches]
        k = np.concatenate(held) if held else np.empty((0, 4), np.int64)
        upto = np.ones(len(k), bool)
        if pivot is not None:
            upto = k[:, 3] <= pivot[3]
            for j in (2, 1, 0):
                upto = (k[:, j] < pivot[j]) | ((k[:, j] == pivot[j]) & upto)
        for side, part in ((0, k[upto]), (1, k[~upto])):
            if len(part):
                yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in (
                    side, len(part), *_median(part))], ["side", "n", *_KEY])
    rows = keys.mapInArrow(run, "side bigint, n bigint, a bigint, b bigint, c bigint, d bigint").collect()
    return [[(r["n"], tuple(r[c] for c in _KEY)) for r in rows if r["side"] == s] for s in (0, 1)]


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The least median with half of all weight up to it."""
    total, seen = sum(n for n, _ in medians), 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, rank: int) -> tuple:
    """The key of 1-based ``rank`` in ascending order. Keys are distinct; the driver only sees
    two sizes and medians per partition and round."""
    report = _report(keys, None)[0]
    left = base = sum(n for n, _ in report)
    low = high = None                       # low < remaining keys <= high
    while True:
        pivot = weighted_median(report)
        if left == 1:
            return pivot
        within = keys if low is None else keys.where(~_below(low))
        within = within if high is None else within.where(_below(high))
        upto, after = _report(within, pivot)
        n = sum(k for k, _ in upto)
        if rank <= n:
            high, report, left = pivot, upto, n
        else:
            low, report, left, rank = pivot, after, sum(k for k, _ in after), rank - n
        if left * SHRINK < base:            # few are left: later rounds need not read the others
            within = keys if low is None else keys.where(~_below(low))
            keys = written(within if high is None else within.where(_below(high)), "remaining")
            base = left


def ranked(winners: DataFrame) -> DataFrame:
    """The winners with their rank: sorted in ranges, numbered by range offsets."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    placed = winners.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            place = pa.array(np.arange(at, at + b.num_rows), pa.int64())
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int64()), place],
                                             [*b.schema.names, "part", "place"])
    table = written(placed.mapInArrow(number, f"{SCORED}, part bigint, place bigint"), "winners")
    # one row per range
    sizes = table.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return table.join(F.broadcast(sizes), "part").withColumn("rank", F.col("base") + F.col("place") + 1).drop(
        "part", "place", "base")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (NULL for those not drawn) of every document."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    table = written(scored(docs, gain), "scored")
    eligible = F.col("n_words") >= min_words
    wanted = table.where(eligible).count() * share[0] // share[1]
    unranked = F.lit(None).cast("bigint")
    if not wanted:
        return table.drop("row").withColumn("rank", unranked)
    keyed = _keyed(table)
    won = eligible & _below(cutoff(keyed.where(eligible).select(*_KEY), wanted))
    marked = keyed.withColumn("won", won).drop(*_KEY)
    lost = marked.where(~F.col("won")).drop("won").withColumn("rank", unranked)
    return lost.unionByName(ranked(marked.where("won").drop("won"))).drop("row")


def query(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank", "n_words")

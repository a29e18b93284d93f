"""Importance resampling against a plain model of the same rules."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import none, odd, odd_rows, odd_texts  # noqa: F401 (fixtures)
from pulsehouse.llm import target_sampling as ts
from pulsehouse.llm.common import written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10_000 for f in grams(text)[1]]


def brute(rows, target, share=(5, 100), least=20):
    s, t = collections.Counter(), collections.Counter()
    for _, x in rows:
        s.update(buckets(x))
    for x in target:
        t.update(buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for key, x in rows:
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, buckets(x)))
        out.append([key, len(buckets(x)), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(grams(x)[0])])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:share[0] * len(able) // share[1]]):
        r[4] = i + 1
    return [tuple(r) for r in out]


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
order = lambda rows: sorted(rows, key=str)
TARGET = ["W1 w2 w3, w4!", None, "", "same line here again and w7 w8"]


@pytest.mark.parametrize("share", [(5, 100), (1, 2), (1, 1)])
def test_odd_documents(spark, odd, share):
    target = written(spark.createDataFrame([(i, x, 1) for i, x in enumerate(TARGET)],
                                           "item_id bigint, text string, row int"), "t-target")
    got = ts.resample(odd, target, share).select(*COLUMNS).collect()
    want = brute([r[:2] for r in odd_rows()], TARGET, share)
    assert order(tuple(r) for r in got) == order(want)


def test_query_draws_the_right_twentieth(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(10, 60)))) for i in range(700)]
    rows += [(5, rows[5][1])] * 3
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), "t-docs")
    target = written(spark.createDataFrame([(x,) for x in TARGET], "text string"), "t-target")
    got = ts.query(spark, docs, target).select(*COLUMNS).collect()
    assert order(tuple(r) for r in got) == order(brute(rows, TARGET))


def test_empty_tables(spark, none, odd):
    assert ts.query(spark, none, odd).count() == 0
    assert ts.query(spark, odd, none).count() == len(odd_rows())


@pytest.mark.parametrize("size", [1, 7, 300, 1 << 20])
def test_hashes_of_joined_words_are_crc32(monkeypatch, size):
    monkeypatch.setattr(ts, "PIECE_BYTES", size)
    texts = odd_texts() + ["a" * 64 + " " + "b" * 65 + " " + "c" * 200 + " d", "a\tb\nc", "ÄÖ9_z", "x"]
    texts = [t for t in texts if t is None or len(t) < 20_000 or size > 7]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    words, n, found = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for row, w, k, hashed, whose in ts._hashed(batch):
        for i, a, b in zip(row.tolist(), w.tolist(), k.tolist()):
            words[i] += a
            n[i] += b
        for i, h in zip(whose.tolist(), hashed.tolist()):
            found[i].append(h)
    for i, t in enumerate(texts):
        assert words[i] == len(grams(t)[0]) and n[i] == len(grams(t)[1])
        assert sorted(found[i]) == sorted(buckets(t))


@pytest.mark.parametrize("shrink", [1, 4, 16])
def test_cutoff_is_the_key_of_that_rank(spark, monkeypatch, shrink):
    monkeypatch.setattr(ts, "SHRINK", shrink)
    rng = random.Random(shrink)
    keys = [(rng.randrange(5), rng.randrange(2), rng.randrange(3), i) for i in range(200)]
    frame = written(spark.createDataFrame(keys, "a bigint, b bigint, c bigint, d bigint").repartition(5), "t-keys")
    ordered = sorted(keys)
    for rank in (1, 2, 57, 199, 200):
        assert ts.cutoff(frame, rank) == ordered[rank - 1]


def test_medians():
    rng = np.random.default_rng(2)
    for n in (1, 2, 9, 100):
        k = rng.integers(0, 4, (n, 4))
        assert tuple(ts._median(k)) == sorted(map(tuple, k.tolist()))[(n - 1) // 2]
    assert ts.weighted_median([(1, (9,)), (5, (3,)), (2, (1,))]) == (3,)

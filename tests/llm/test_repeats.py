"""Suffix arrays and exact substring removal, against brute force."""
import hashlib
import random
from collections import Counter
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import none, odd, odd_rows, words  # noqa: F401
from pulsehouse.llm import suffix_dedup
from pulsehouse.llm.common import written
from pulsehouse.llm.suffix_array import suffix_array


def test_suffix_array_of_small_strings():
    rng = random.Random(5)
    for _ in range(1500):
        x = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 50))] + [0]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def brute(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def shared_texts():
    rng = random.Random(9)
    passage = " ".join(words(rng, 90, 10**6))
    texts = []
    for k in range(30):      # a passage seen whole, cut short at either end, and twice in one text
        a, z = rng.randint(0, 200), len(passage) - rng.randint(0, 200)
        texts.append(" ".join(words(rng, 30, 10**6)) + passage[a:z] + " ".join(words(rng, 30, 10**6)))
    texts.append(passage + " middle " + passage)
    texts.append("é" * 150 + passage[:199])                    # 199 bytes are too few
    texts.append("ab" * 500)                                   # overlapping repeats of itself
    texts += texts[:6] + texts[:1]                             # copies that hold the shared passage
    return texts


@pytest.mark.parametrize("group, early", [(1000, 32), (3, 32), (1000, 2), (3, 2), (1, 3)])
def test_removal_is_exact(spark, monkeypatch, group, early):
    """With low ``group`` most cores are split into finer blocks and single windows, with low
    ``early`` most regions pass by their core's bucket."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "EARLY", early)
    texts = shared_texts()
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3), "t-shared")
    got = {r["doc_id"]: r for r in suffix_dedup.query(spark, docs).collect()}
    for i, (n, gone, runs, sha, _) in enumerate(brute(texts)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, runs, sha), i


def test_a_shared_core_leaves_one_mark_a_task_in_its_bucket():
    """However many documents hold a passage, its buckets get at most EARLY entries from a task."""
    rng = random.Random(3)
    passage = " ".join(words(rng, 60, 10**6))
    for n in (200, 2000):
        texts = pa.array([" ".join(words(rng, 8, 10**6)) + passage + " ".join(words(rng, 8, 10**6)) for _ in range(n)])
        keys = pa.array([b"%016d" % i for i in range(n)])
        with mock.patch.object(suffix_dedup.TaskContext, "get", return_value=mock.Mock(partitionId=lambda: 1)):
            out = pa.Table.from_batches(suffix_dedup._deal(8)([pa.RecordBatch.from_arrays([keys, texts], ["row_key", "text"])]))
        dealt = [np.frombuffer(r["entries"], suffix_dedup.REGION) for r in out.to_pylist() if r["bucket"] >= 0]
        most = Counter(np.concatenate(dealt)["core"].tolist()).most_common(1)[0][1]
        early = [r for r in out.to_pylist() if r["bucket"] < 0 and r["entries"]]
        assert most < suffix_dedup.EARLY and sum(len(r["entries"]) for r in early) > n * suffix_dedup.REGION.itemsize


@pytest.mark.parametrize("width", [64, 8, 1])
def test_finer_blocks_hold_every_window_once(width):
    texts = [t.encode() for t in shared_texts()]
    text, core, same, x, n = suffix_dedup.regions(texts, width)
    held = Counter((t, s) for t, a, k in zip(text.tolist(), x.tolist(), n.tolist()) for s in range(a, a + k + 1))
    assert held == Counter((t, s) for t, raw in enumerate(texts) for s in range(len(raw) - 199)) and n.max() < width
    of = {(t, s): c for t, c, a, k in zip(text.tolist(), core.tolist(), x.tolist(), n.tolist()) for s in range(a, a + k + 1)}
    cores: dict[bytes, set] = {}
    for (t, s), c in of.items():
        cores.setdefault(texts[t][s:s + 200], set()).add(c)
    assert all(len(c) == 1 for c in cores.values())            # equal windows meet in one core


def test_odd_documents_and_empty_table(spark, odd, none):
    rows = odd_rows()
    want = Counter((r[0], *b[:4]) for r, b in zip(rows, brute([r[1] for r in rows])))
    got = Counter(tuple(r) for r in suffix_dedup.query(spark, odd).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == want
    out = suffix_dedup.strip(odd)
    assert out.columns == odd.columns and out.schema.simpleString() == odd.schema.simpleString()
    texts = Counter((r["doc_id"], r["text"], r["n_chars"], r["spans"]) for r in out.collect())
    kept = [b[4].decode("utf-8", "ignore") for b in brute([r[1] for r in rows])]
    assert texts == Counter((r[0], k, len(k), r[11]) for r, k in zip(rows, kept))
    assert suffix_dedup.query(spark, none).count() == 0 and suffix_dedup.strip(none).count() == 0


def test_very_long_text_is_cut_into_parts_without_loss(monkeypatch):
    rng = random.Random(4)
    text = " ".join(words(rng, 3000, 10**6)).encode()
    whole = suffix_dedup.regions([text])
    monkeypatch.setattr(suffix_dedup, "_POSITION", 12)
    parts = suffix_dedup.regions([text])
    starts = lambda r: sorted(s for x, n in zip(r[3].tolist(), r[4].tolist()) for s in range(x, x + n + 1))
    assert starts(whole) == starts(parts) == list(range(len(text) - 199))


@pytest.mark.parametrize("rest", [1, 57, 199, 200, 201])
def test_hashes_of_a_text_cut_into_parts_are_exact(monkeypatch, rest):
    """Also with a last part too short for a window."""
    cut = (1 << 12) - suffix_dedup.LENGTH
    text = " ".join(words(random.Random(6), 3000, 10**6)).encode()[:3 * cut + rest]
    whole = suffix_dedup.regions([text])
    monkeypatch.setattr(suffix_dedup, "_POSITION", 12)
    parts = suffix_dedup.regions([text])
    assert [c.dtype for c in parts] == [c.dtype for c in whole] == [c.dtype for c in suffix_dedup.regions([b""])]
    assert set(parts[1].tolist()) == set(whole[1].tolist())

    def uncut(r):       # regions that lie in one part
        rows = zip(*[c.tolist() for c in r[1:]])
        return {(core, same, x, n) for core, same, x, n in rows if not any(x <= b <= x + n + 1 for b in range(cut, len(text), cut))}
    assert uncut(parts) == uncut(whole) and len(uncut(whole)) > 50

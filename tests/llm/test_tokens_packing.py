"""Tokenizer cache, code streams, token files, differencing and packing, against plain encoding."""
import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_rows import odd, odd_rows, odd_texts  # noqa: F401 (fixture)
from pulsehouse.llm import packing, token_output
from pulsehouse.llm.tokens import Encoder


def plain(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda x: np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_tokenizers(name):
    texts = odd_texts() + ["  lead", "trail  ", "a  b", "I'll we're don't 'S", "x\n\n\ny", "\t\t", "é È ß ×÷ ²", "Ÿ ω", "a <|endoftext|> b",
                            "<|startoftext|>x<|ENDOFTEXT|> <|endoftext|", "say <|endoftext|><|endoftext|>."]
    enc, want = Encoder(public_tokenizers.path(name)), plain(name)
    for _ in range(2):      # cold and warm cache
        for t, raw in zip(texts, enc.encode(texts)):
            assert np.frombuffer(raw, enc.dtype).tolist() == want(t).tolist(), t and t[:40]


def test_code_streams_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_output.encode_block(x)
        assert len(control) == -(-n // 4)
        assert token_output.decode_block(control, data, n).tolist() == x.tolist()


def test_token_files_of_odd_documents(spark, odd):
    got = sorted(token_output.query(spark, odd).collect(), key=lambda r: r["start"])
    want = plain("word_bpe_49k.json")
    ids = {}
    for r in odd_rows():
        ids.setdefault(r[0], []).append(np.append(want(r[1]), 2).astype("<u4").tobytes())
    keys = sorted(ids, key=lambda k: (k is not None, k or 0))
    assert [r["doc_id"] for r in got] == [k for k in keys for _ in ids[k]]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        assert (r["n_tokens"], r["ids_crc32"]) in [(len(x) // 4, zlib.crc32(x)) for x in ids[r["doc_id"]]]


def test_differencing_levels_windows():
    rng = np.random.default_rng(2)
    for k, n in ((1, 5), (3, 3), (7, 40), (64, 300), (64, 900)):
        x = rng.integers(1, 257, n)
        owner, most = packing.difference(x, k)
        sums = np.bincount(owner, x, k)
        assert sums.sum() == x.sum() and sums.max() == most
    assert sums.max() - sums.min() <= 0.005 * sums.mean()       # near-equal: 900 items in 64 windows ...
    greedy = [0] * k
    for v in sorted(x.tolist(), reverse=True):
        heapq.heapreplace(greedy, greedy[0] + v)
    assert sums.max() - sums.min() < max(greedy) - min(greedy)  # ... and nearer than longest-first
    x = rng.integers(1, 257, 500)
    owner = packing.windows(x, 1024)
    sums = np.bincount(owner, x)
    assert sums.max() <= 1024 and len(sums) <= -(-x.sum() // 1024) + 1
    assert sorted(packing.windows(np.array([1000, 1000, 1000]), 1024)) == [0, 1, 2]   # 3000 needs 3, not 4


def test_packed_odd_documents(spark, odd):
    cut = packing.pieces(odd).cache()
    rows = packing.pack(cut).collect()
    want = plain("byte_bpe_50k.json")
    total = sum(len(want(r[1])) + 1 for r in odd_rows())
    assert sum(r["length"] for r in rows) == total
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    full = {}
    for r in odd_rows():
        full.setdefault(r[0], []).append(np.append(want(r[1]), 0).astype("<u4").tobytes())
    for r in rows:
        cuts = [x[4 * r["start"]:4 * (r["start"] + r["length"])] for x in full[r["doc_id"]] if len(x) // 4 == r["doc_tokens"]]
        assert r["ids_crc32"] in [zlib.crc32(x) for x in cuts]
    seqs = packing.sequences(cut, packing.pack(cut)).collect()
    assert sum(len(r["ids"]) for r in seqs) == 4 * total
    cut.unpersist()


def test_padding_is_small():
    rng = random.Random(3)
    lengths = np.array([rng.randint(1, 256) for _ in range(1000)])
    k = packing.windows(lengths, 1024).max() + 1
    assert 1 - lengths.sum() / (1024 * k) < 0.02


def test_words_are_looked_up_once_a_slice():
    """A word's ids are asked of the cache once for all its places in the texts encoded together."""
    class Counting(dict):
        asked = 0

        def get(self, *a):
            Counting.asked += 1
            return super().get(*a)

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)
    name = "word_bpe_49k.json"
    enc, want = Encoder(public_tokenizers.path(name)), plain(name)
    texts = ["  Red fox,\n\tred  Fox's 42 caf\xe9\xd7\xff ", "", None, " \n", "red fox " * 500, "fox\n", "na\u00efve \u4e2d fox", "x"]
    enc.encode(texts)
    enc.cache = Counting(enc.cache)
    assert enc.encode(texts) == [np.array(want(t), enc.dtype).tobytes() for t in texts]
    assert Counting.asked < 20


def test_runs_of_letters_digits_and_signs_are_looked_up_once_a_slice():
    """White space, quotes and signs in all orders; a word met again with other signs is not learned anew."""
    rng = random.Random(5)
    parts = list("abzAZst'\"=.,;!?*#()09 \n\t\r éÀ×÷ß_-<>") + ["'s", "'re", "'RE", "don't", " '", "\n'", "''", "  ", "\r\n", "\n\n", "word", "I'll"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 60))) for _ in range(4000)]
    enc, want = Encoder(public_tokenizers.path("byte_bpe_50k.json")), plain("byte_bpe_50k.json")
    for at in range(0, len(texts), 256):
        for t, raw in zip(texts[at:at + 256], enc.encode(texts[at:at + 256])):
            assert np.frombuffer(raw, enc.dtype).tolist() == want(t).tolist(), t
    enc.cache.clear()
    enc.encode(["say word say", " word. word, word*** (word) word9 word?!"])
    assert sorted(enc.cache) == sorted(["say", " word", " say", ".", ",", "***", " (", "word", ")", "9", "?!"])

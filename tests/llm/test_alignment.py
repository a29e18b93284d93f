"""Cross-tokenizer alignment against a plain per-token model."""
import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_rows import none, odd, odd_rows  # noqa: F401 (fixtures)
from pulsehouse.llm import alignment

A_PATH, B_PATH = alignment.tokenizer_paths()


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) per text, and the links of all."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    alphabet = alignment._byte_alphabet()
    links, figures = [], []
    for t in texts:
        links.append([])
        figures.append((0, 0, 0, ""))
        if not t:
            continue
        raw = (" " + t).encode()
        ia = a.encode(" " + t, add_special_tokens=False)
        ba = [bytes(alphabet[c] for c in x) for x in ia.tokens]
        ib = b.encode(t)
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        if b"".join(ba) != raw or b"".join(bb) != raw:
            continue

        def spans(parts):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            return list(zip([0, *ends], ends))
        sa, sb = spans(ba), spans(bb)
        i = j = 0
        while i < len(sa) and j < len(sb):
            links[-1].append((ia.ids[i], ib[j]))
            end = min(sa[i][1], sb[j][1])
            i, j = i + (sa[i][1] == end), j + (sb[j][1] == end)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        text, begin = [], 0
        for stop in common:
            text.append(",".join(str(k) for k, s in zip(ia.ids, sa) if begin < s[1] <= stop) + "|"
                        + ",".join(str(k) for k, s in zip(ib, sb) if begin < s[1] <= stop))
            begin = stop
        figures[-1] = (len(sa), len(sb), len(common), hashlib.sha256(";".join(text).encode()).hexdigest())
    count = collections.Counter(x for doc in links for x in doc)
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = [(f[0], f[1], f[2], len(doc), sum(count[x] == most[x[1]] for x in doc), sum(count[x] for x in doc), f[3])
           for f, doc in zip(figures, links)]
    return out, count


TEXTS = ["  lead", "a  b ", "x\n\n\ny\tz", "a ▁ b", "naïve café", "<0x41> </s> <s>", "a　b", "12 345, 6.7", " ", "\n"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def short(rows):
    return [r for r in rows if r[1] is None or len(r[1]) < 20_000]


def test_alignment_of_odd_documents(spark, odd):
    from pulsehouse.llm.common import written
    rows = short(odd_rows()) + [(1000 + i, t) + (None,) * 11 for i, t in enumerate(TEXTS)]
    docs = written(spark.createDataFrame([r[:2] + (7,) for r in rows], "doc_id bigint, text string, flush bigint")
                   .repartition(5), "t-align")
    want, count = brute([r[1] for r in rows])
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    got = sorted([tuple(r) for r in alignment.query(spark, docs).select("doc_id", *COLUMNS).collect()], key=key)
    assert got == sorted([(r[0], *w) for r, w in zip(rows, want)], key=key)
    pairs = {(r["a_id"], r["b_id"]): r["n"] for r in alignment.pair_counts(docs, A_PATH, B_PATH).collect()}
    assert pairs == dict(count)


def test_small_flushes_levels_and_parts_change_nothing(spark, odd, monkeypatch):
    from pulsehouse.llm.common import written
    rows = short(odd_rows())
    docs = written(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(6), "t-align")
    want, _ = brute([r[1] for r in rows])
    for name, value in (("FLUSH_RECORDS", 1), ("FAN", 3), ("PART_CHARS", 60)):
        monkeypatch.setattr(alignment, name, value)
    got = sorted(str(tuple(r)) for r in alignment.query(spark, docs).select("doc_id", *COLUMNS).collect())
    assert got == sorted(str((r[0], *w)) for r, w in zip(rows, want))


def test_empty_table(spark, none):
    assert alignment.query(spark, none).count() == 0


def test_parts_spell_the_text_and_align_as_the_whole():
    rng = random.Random(3)
    both = alignment.pair(A_PATH, B_PATH)
    for n in (0, 5, 300):
        text = "".join(rng.choice(["a", "bc ", "  ", "\n", " d", "é", "1", ",", " \t"]) for _ in range(n))
        cut = alignment.parts(text, 10)
        assert "".join(cut) == " " + text and all(p[0] == " " for p in cut)
        for k in (0, 1):
            whole = both.encode([" " + text])[k][0]
            assert [i for p in both.encode(cut)[k] for i in p] == list(whole)


@pytest.mark.parametrize("block", [1, 4, 1 << 14])
def test_heap_merge_counts_each_key(block):
    rng = np.random.default_rng(4)
    heads, want = [], collections.Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 60, rng.integers(0, 50))).astype(np.uint64)
        sums = rng.integers(1, 9, len(keys)).astype(np.uint64)
        heads.append((keys, sums))
        for k, s in zip(keys.tolist(), sums.tolist()):
            want[k] += s
    got = [(k, s) for ks, ss in alignment.merge(heads, block) for k, s in zip(ks.tolist(), ss.tolist())]
    assert got == sorted(want.items())


def test_byte_planes_round_trip():
    rng = np.random.default_rng(5)
    for t in ("<u2", "<u4", "<u8"):
        for n in (0, 1, 1000):
            x = rng.integers(0, 60_000, n).astype(t)
            assert alignment.unsqueeze(alignment.squeeze(x), t).tolist() == x.tolist()

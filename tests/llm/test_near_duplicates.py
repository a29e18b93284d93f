"""Shingle sets, signatures, the join and its components, against brute force."""
import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import SCHEMA, none, odd, odd_rows, odd_texts, words  # noqa: F401
from pulsehouse.llm import ngram_join
from pulsehouse.llm.common import written
from pulsehouse.llm.shingles import shingle_sets


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    """doc_id -> least doc_id reachable (rows of one id are one node)."""
    sets = [(r[0], brute_set(r[1])) for r in rows if r[0] is not None]
    up = {i: i for i, _ in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = find(i), find(j)
            up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def test_sets_are_exact():
    texts = odd_texts()
    for t, s in zip(texts, shingle_sets(texts)):
        assert len(s) == len(brute_set(t))


def test_every_linked_pair_shares_a_signature():
    """The pigeonhole holds at every size, also when most shingles count as frequent."""
    rng = np.random.default_rng(11)
    linked = 0
    for _ in range(150):
        n = int(rng.choice([1, 2, 3, 5, 8, 12, 20, 40, 90, 200, 600]))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        sets = [base]
        for _ in range(6):
            out, more = rng.integers(0, max(1, len(base) // 6) + 1, 2)
            s = np.unique(np.concatenate([rng.permutation(base)[out:], rng.integers(0, 2**63, more, dtype=np.uint64)]))
            if len(s):
                sets.append(s)
        share = rng.choice([0, 0.3, 0.6, 0.9, 1])
        frequent = ngram_join.Frequent(np.sort(rng.permutation(base)[:int(len(base) * share)]))
        who, sig, short, short_sig = ngram_join.signatures(sets, frequent)
        for i, j in combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                linked += 1
                assert (set(sig[who == i].tolist()) & set(sig[who == j].tolist())
                        or set(short_sig[short == i].tolist()) & set(short_sig[short == j].tolist()))
    assert linked > 500


def test_join_of_odd_documents(spark, odd):
    got = ngram_join.query(spark, odd).collect()
    rows = odd_rows()
    assert len(got) == len(rows)
    want = brute_components(rows)
    sizes = {}
    for r in rows:
        sizes.setdefault(r[0], set()).add(len(brute_set(r[1])))
    for r in got:
        assert r["n_shingles"] in sizes[r["doc_id"]]
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]]


def family(rng, size):
    """Near copies in a chain: neighbours are alike, the ends are not; and others that share a passage."""
    w = words(rng, 200, 10**6)
    out = []
    for k in range(size):
        w = list(w)
        w[(17 * k) % 200] = f"edit{k}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("least", [32, 2])
def test_families_and_frequent_passages(spark, monkeypatch, least):
    """With ``least`` = 2 nearly all shingles of a family are frequent: the short name space."""
    import random
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", least << ngram_join.SAMPLE_BITS if least == 2 else least)
    monkeypatch.setattr(ngram_join, "SAMPLE_BITS", 0 if least == 2 else ngram_join.SAMPLE_BITS)
    rng = random.Random(3)
    passage = " ".join(words(rng, 80, 10**6))
    texts = family(rng, 12) + family(rng, 5) + [passage + " " + " ".join(words(rng, 60, 10**6)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), "t-family")
    want = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.query(spark, docs).collect()}
    assert got == want and len(set(got.values())) > 20


def test_links_by_matrix_products(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.append(base[rng.random(300) > 0.1], rng.integers(0, 2**63, 5, dtype=np.uint64))) for _ in range(30)]
    sets += [np.array([k], np.uint64) for k in (1, 2)]
    want = np.zeros((32, 32), bool)
    for i, j in combinations(range(32), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        want[i, j] = want[j, i] = 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
    assert (ngram_join.linked(sets) == want).all() and 50 < want.sum() < 900
    assert (ngram_join.linked(sets[:9], sets[9:]) == want[:9, 9:]).all()


@pytest.mark.parametrize("tile", [1024, 3])
def test_all_links_are_listed_and_counted(spark, monkeypatch, tile):
    """Also those inside a group of near copies, and with a component dealt to many tiles."""
    import random
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rng = random.Random(5)
    texts = family(rng, 14) + family(rng, 6) + [None, " ", "a b"] + [" ".join(words(rng, 60, 10**6)) for _ in range(9)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[3]), (101, texts[3]), (102, texts[24]), (None, texts[4]), (2, texts[2])]
    sets = [brute_set(t) for _, t in rows]
    alike = [[i != j and bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets)]
             for i, a in enumerate(sets)]
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), "t-links")
    got = sorted((r["doc_id"] or -1, r["n_links"]) for r in ngram_join.query(spark, docs).collect())
    assert got == sorted((i or -1, sum(x)) for (i, _), x in zip(rows, alike))

    links, members = (x.collect() for x in ngram_join.Join(docs).links())
    of: dict = {}
    for r in members:
        of.setdefault(r["node"], []).append(-1 if r["doc_id"] is None else r["doc_id"])
    pairs = [sorted((x, y)) for a, b in links for x in of[a] for y in of[b]]
    pairs += [sorted(p) for ids in of.values() for p in combinations(ids, 2)]
    want = [sorted(-1 if rows[k][0] is None else rows[k][0] for k in (i, j))
            for i, j in combinations(range(len(rows)), 2) if alike[i][j]]
    assert sorted(pairs) == sorted(want) and len(want) > 60


def test_one_of_each_group_stays(spark, odd, none):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = brute_components(odd_rows())
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert ids.count(None) == 2
    assert ngram_join.keep_one(none).count() == 0 and ngram_join.query(spark, none).count() == 0


def test_pairs_of_a_family_are_looked_at_once(monkeypatch):
    """Every pair of one group and two components whose sizes may link comes out, whatever the block size."""
    rng = np.random.default_rng(6)
    rows = sorted((int(rng.integers(4)), int(rng.integers(30, 60)), i, i % 5, int(rng.integers(1, 3))) for i in range(40)
                  for _ in range(2))
    rows = [(*r[:4], 0 if r[0] < 2 else r[4]) for r in rows]       # two groups whole, two as pairs of tiles
    g, n, place, label, side = (np.array(x, np.int64) for x in zip(*rows))
    want = {(min(p, q), max(p, q)) for (a, m, p, x, u) in rows for (b, k, q, y, v) in rows
            if a == b and x != y and m <= k <= m * 4 // 3 and (u == 0 or u != v)}
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(ngram_join, "ACROSS_PAIRS", block)
        codes = [int(c) for found in ngram_join._candidates(g, label, n, side, place) for c in found]
        assert {(c >> 32, c & 0xFFFFFFFF) for c in codes} == want


def test_pairs_of_many_groups_come_once_and_in_bounded_memory():
    """Near copies that share many groups: as many pairs out as there are, and few held at a time."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64))
    sets = [np.unique(np.append(base[rng.random(60) < 0.95], rng.integers(0, 2**63, 4, dtype=np.uint64))) for _ in range(1200)]
    n, node, label = np.array([len(s) for s in sets]), rng.permutation(10**6)[:1200], np.arange(1200) // 2
    member = np.concatenate([np.flatnonzero(rng.random(1200) < 0.8) for _ in range(12)])
    g = np.repeat(np.arange(12), np.diff(np.append(np.flatnonzero(np.append(True, np.diff(member) < 0)), len(member))))
    cols = {"bucket": g * 0, "g": g, "node": node[member], "label": label[member], "n": n[member], "side": g * 0}
    members = pa.table({c: pa.array(v, pa.int64()) for c, v in cols.items()} | {"bins": pa.nulls(len(g), pa.binary())})
    none_ = pa.nulls(1200, pa.int64())
    outlines = pa.table([pa.array(n * 0), none_, pa.array(node), none_, pa.array(n), none_,
                         pa.array([ngram_join.outline(s) for s in sets], pa.binary())], members.column_names)
    table = pa.concat_tables([members, outlines])
    tracemalloc.start()
    got = ngram_join._across((pa.scalar(0),), table)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    x = np.stack([np.frombuffer(ngram_join.outline(s), "u1").astype(int) for s in sets])
    there = np.zeros((12, 1200), bool)
    there[g, member] = True
    want = np.triu((there.T.astype(int) @ there.astype(int) > 0) & (label[:, None] != label))
    i, j = np.nonzero(want)
    ok = np.maximum(n[i], n[j]) <= np.minimum(n[i], n[j]) * 4 // 3
    ok[ok] = [np.abs(x[a] - x[b]).sum() <= (n[a] + n[b]) // 7 for a, b in zip(i[ok], j[ok])]
    want = {(min(a, b), max(a, b)) for a, b in zip(node[i[ok]].tolist(), node[j[ok]].tolist())}
    pairs = list(zip(*(c.to_pylist() for c in got.columns)))
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 10_000
    assert peak < 60, peak


@pytest.mark.parametrize("group", [2, 5])
def test_groups_cut_into_tiles_lose_no_link(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "ACROSS_ROWS", 7)
    rng = random.Random(9)
    shared = words(rng, 40, 5000)
    rows = []
    for i in range(40):            # a passage in common, and families that link across it
        own = shared + words(random.Random(i // 4), 30, 5000)
        own[rng.randrange(len(own))] = f"x{i}"
        rows.append((i, " ".join(own)))
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), "t-tiles")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.query(spark, docs).collect()}
    assert got == brute_components(rows)


def test_outline_bound_never_rules_out_a_link():
    rng = np.random.default_rng(7)
    for size in (5, 60, 500, 5000):
        base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for off in (0, 1, len(base) // 8, len(base) // 7, len(base) // 4):
            other = np.unique(np.append(base[off:], rng.integers(0, 2**64, off, dtype=np.uint64)))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 75 * (len(base) + len(other) - both):
                x = ngram_join._opened([ngram_join.outline(base), ngram_join.outline(other)])
                assert ngram_join._within(x, np.array([0]), np.array([1]), np.array([len(base) + len(other)])).all()


def test_frequent_shingles_do_not_depend_on_the_partitions(spark):
    """Texts that share passages, with copies everywhere: the same set from 1, 4 and 64 partitions."""
    rng = random.Random(8)
    passages = [" ".join(words(rng, 30, 3000)) for _ in range(3)]
    texts = [" ".join(words(rng, 20, 3000)) + " " + passages[i % 3] + " " + " ".join(words(rng, 20, 3000)) for i in range(900)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:1] * 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = []
    for n in (1, 4, 64):
        join = ngram_join.Join(written(docs.repartition(n), "t-dealt"))
        found.append(join.frequent.tolist())
    assert found[0] == found[1] == found[2]
    every = {h for p in passages for h in shingle_sets([p])[0].tolist()}
    assert every <= set(found[0]) and len(found[0]) < 3 * len(every)
    assert not set(shingle_sets([texts[0].split(passages[0])[0]])[0].tolist()) & set(found[0])   # copies count once

"""Rule ledger, fingerprints and mixing: brute force, policies, exact quotas, odd documents."""
import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from llm_rows import none, odd, odd_rows  # noqa: F401
import pytest

from pulsehouse.llm import fingerprints, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(win)
    hit = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def test_ledger_measures_and_policies(spark, odd, none):
    got = Counter(tuple(r)[:6] for r in quality_rules.query(spark, odd).collect())
    assert got == Counter((r[0], *measures(r[1])) for r in odd_rows())
    for r in quality_rules.query(spark, odd).collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    out = quality_rules.filter_documents(odd)
    assert out.columns == odd.columns
    assert out.count() == quality_rules.query(spark, odd).where("kept").count()
    assert quality_rules.query(spark, none).count() == 0 and quality_rules.filter_documents(none).count() == 0


def test_ablation_is_what_leaving_a_rule_out_does(spark, odd):
    led = quality_rules.ledger(odd.select("doc_id", "text")).cache()
    total = led.where(quality_rules.kept("strict-1")).count()
    for r in quality_rules.ablation(led, "strict-1").collect():
        rest = [x.name for x in quality_rules.RULES if x.name != r["rule"]]
        without = led.where(F.col("failed_bits").bitwiseAND(F.lit(quality_rules.policy_mask(rest))) == 0).count()
        assert without == total + r["only_this_rule"] and r["kept_by_policy"] == total
    led.unpersist()


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_fingerprints_of_odd_documents(spark, odd, none):
    rows = [r for r in fingerprints.query(spark, odd).collect()]
    assert len(rows) == len(odd_rows())
    by_id = {r[0]: r[1] or "" for r in odd_rows() if r[0] is not None and r[0] not in (18, 27)}
    order = sorted((r[0] for r in odd_rows() if r[0] is not None), reverse=True)
    prints, off = {}, []
    for r in rows:
        if r["doc_id"] not in by_id:
            continue
        text = by_id[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        nxt = order[order.index(r["doc_id"]) + 1] if order.index(r["doc_id"]) + 1 < len(order) else None
        if nxt in by_id:
            cut = len(text) // 3
            edited = text[:len(text) - cut] + by_id[nxt][:cut]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b = shingles(text), shingles(edited)
            if len(a) > 30:
                off.append(abs(r["near_edited"] - len(a & b) / len(a | b)))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert max(off) < 0.2 and sum(off) / len(off) < 0.08
    assert fingerprints.query(spark, none).count() == 0


def test_next_row_wraps_and_crosses_ranges(spark):
    docs = spark.range(500).selectExpr("id * 7 AS doc_id", "concat('t', id) AS text").repartition(5)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(docs, "doc_id", ["text"]).collect()}
    assert got == {i * 7: f"t{(i - 1) % 500}" for i in range(500)}
    one = fingerprints.with_next(docs.where("doc_id = 0"), "doc_id", ["text"]).collect()
    assert [r["next_text"] for r in one] == ["t0"]


def test_targets_are_water_filling(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 50), ("d", 0), (None, 5), ("é", 300), ("Z", 7)]
    df = spark.createDataFrame(sizes, "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    names = sorted((s for s, _ in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    cap, total = {s: 2.0 * n for s, n in sizes}, 1.5 * sum(n for _, n in sizes)
    want, free = {}, set(names)
    while free:                      # reshare the excess until none is above its cap
        level = (total - sum(want.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap[s]}
        if not over:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: cap[s] for s in over}
        free -= over
    assert all(abs(got[s] - want[s]) < 1e-6 for s in names)


@pytest.mark.parametrize("group", [1000, 2])
def test_tree_uses_up_every_quota(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "SOURCES_PER_GROUP", group)
    blocks = {1: 40, 2: 0, 3: 7, 4: 1, 5: 23, 9: 2}
    quotas = spark.createDataFrame(list(blocks.items()), "source_no bigint, blocks bigint")
    rows = mixing.split_tree(quotas, 3).collect()
    assert {s: sum(r["blocks"] for r in rows if r["source_no"] == s) for s in blocks} == blocks
    per_shard = [sum(r["blocks"] for r in rows if r["shard"] == k) for k in range(8)]
    assert max(per_shard) - min(per_shard) <= 1
    assert len({(r["source_no"], r["shard"]) for r in rows}) == len(rows) and all(r["blocks"] > 0 for r in rows)


def test_grouped_draws_have_the_hypergeometric_mean(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_PER_GROUP", 2)
    blocks = {1: 30, 2: 10, 3: 20, 4: 4}
    quotas = spark.createDataFrame(list(blocks.items()), "source_no bigint, blocks bigint")
    left = {s: [] for s in blocks}
    for seed in range(12):
        monkeypatch.setattr(mixing, "SEED", seed)
        got = {r["source_no"]: r["blocks"] for r in mixing.split_tree(quotas, 1).where("shard = 0").collect()}
        assert sum(got.values()) == 32
        for s in blocks:
            left[s].append(got.get(s, 0))
    assert all(abs(sum(left[s]) / 12 - n / 2) < 2 for s, n in blocks.items())
    assert len(set(left[1])) > 1


def test_any_number_of_sources_is_mixed(spark, odd, monkeypatch):
    few = Counter(map(tuple, mixing.query(spark, odd).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert Counter(map(tuple, mixing.query(spark, odd).collect())) == few


def test_documents_go_where_the_tree_drew_them(spark, odd, monkeypatch):
    def shards(levels):
        monkeypatch.setattr(mixing, "levels_for", lambda _: levels)
        monkeypatch.setattr(mixing, "BLOCK_WORDS", 40)
        rows = mixing.query(spark, odd).collect()
        assert all((r["n_shards"] == 0) == (r["taken"] == 0) == (r["first_shard"] is None) for r in rows)
        return {r["first_shard"] for r in rows} - {None}, Counter((r["doc_id"], r["taken"]) for r in rows)
    (two, taken2), (five, taken5) = shards(1), shards(4)
    assert two <= {0, 1} and max(five) > 1 and taken2 == taken5


def test_equal_rows_are_numbered_over_tasks(spark):
    df = spark.createDataFrame([(1, "a b", "s", None)] * 50 + [(1, "a b", None, "s")] * 3 + [(2, None, "s", None)],
                               "doc_id bigint, text string, source string, lang string").repartition(7)
    rows = mixing.supply(df, "doc_id").collect()
    by = {}
    for r in rows:
        by.setdefault((r["uid"], r["uid2"]), []).append(r["nth"])
    assert sorted(map(len, by.values())) == [1, 3, 50]
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())


def test_mix_of_odd_documents(spark, odd, none):
    rows = mixing.query(spark, odd).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        t = by.setdefault((r["source_size"], r["target"]), [0])
        t[0] += r["taken"]
    assert all(abs(t[0] - target) <= 1 for (_, target), t in by.items())
    again = mixing.query(spark, odd).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert sum(len(WORD.findall(r["text"])) for r in out.collect()) == sum(r["taken"] for r in rows)
    assert mixing.query(spark, none).count() == 0 and mixing.mix(none).count() == 0

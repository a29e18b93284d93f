"""Languages, quality, toxicity and fingerprints against plain versions of their methods."""
import itertools
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm_rows import labels, odd, odd_rows  # noqa: F401
from pulsehouse.llm import fingerprints, language_id, quality_classifier, toxicity
from pulsehouse.llm.common import documents, ship

SF = "/root/testdata/sf0.001"
M = 2**64 - 1


def plain_grams(text):
    line = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    line = " " + " ".join(line.split(" ")) + " "
    line = re.sub(" +", " ", line)
    if line.strip() == "":
        return []
    out = [c for c in line if c != " "] + [line[i:i + 2] for i in range(len(line) - 1)]
    return out + [line[i:i + 3] for i in range(len(line) - 2) if line[i + 1] != " "]


def plain_profile(texts):
    count = Counter(g for t in texts for g in plain_grams(t))
    return [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:language_id.PROFILE]]


def test_languages_are_the_plain_out_of_place_distance(spark, odd):
    ship(spark)
    for docs in (documents(spark, SF), odd):
        rows = docs.select("doc_id", "text", "lang").collect()
        train = defaultdict(list)
        for r in rows:
            fold = None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 4
            if r["lang"] is not None and fold != 2:
                train[r["lang"]].append((r["doc_id"], r["text"]))
        profiles = {k: {g: i for i, g in enumerate(plain_profile(t for i, t in v if i is not None))} for k, v in train.items()}
        want = Counter()
        for r in rows:
            own = plain_profile([r["text"]])
            far = sorted((sum(abs(p[g] - i) if g in p else language_id.PROFILE for i, g in enumerate(own)), k)
                         for k, p in profiles.items())
            score = 1 - far[0][0] / far[1][0] if far[1][0] else 0.0
            want[(r["doc_id"], far[0][1], score) if own else (r["doc_id"], "und", 0.0)] += 1
        got = language_id.query(spark, docs).collect()
        assert Counter((r["doc_id"], r["lang_pred"], r["score"]) for r in got) == want


def plain_shape(word):
    def kind(c):
        return next((k for k, r in (("A", "[A-ZÀ-ÖØ-Þ]"), ("a", "[a-zß-öø-ÿ]"), ("0", "[0-9]")) if re.match(r, c)), None)
    out = ""
    for k, run in itertools.groupby(word, kind):
        run = list(run)
        out += "".join(run) if k is None else "AA" if k == "A" and len(run) > 1 else k
    return out


def plain_bucket(*parts):
    x = 0x9E3779B97F4A7C15
    for p in parts:
        x = (x ^ p) * 0xBF58476D1CE4E5B9 & M
        x ^= x >> 29
    return x % quality_classifier.BUCKETS


def plain_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    w = [zlib.crc32(x.encode()) for x in words]
    s = [zlib.crc32(plain_shape(x).encode(), 77) ^ ((i > 0 and w[i] == w[i - 1]) << 40) for i, x in enumerate(words)]
    out = [plain_bucket(1, x) for x in w] + [plain_bucket(2, *x) for x in zip(w, w[1:])]
    out += [plain_bucket(3, x) for x in s] + [plain_bucket(4, *x) for x in zip(s, s[1:])]
    return Counter(out + [plain_bucket(5, *x) for x in zip(s, s[1:], s[2:])])


def plain_ftrl(rows):
    """rows: (features, label) in order; the weights of follow-the-regularised-leader updates."""
    q = quality_classifier
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= q.L1:
            return 0.0
        return -(z[i] - math.copysign(q.L1, z[i])) / ((q.BETA + math.sqrt(n[i])) / q.ALPHA + q.L2)
    for _ in range(q.EPOCHS):
        for f, y in rows:
            x = {i: k / math.sqrt(max(1, f.total())) for i, k in f.items()} | {q.BUCKETS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * x[i] for i in x)))))
            for i in x:
                g = (p - y) * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / q.ALPHA * w[i]
                n[i] += g * g
    return defaultdict(float, {i: weight(i) for i in list(z)})


def test_quality_is_the_plain_updates_and_dot_products(spark):
    ship(spark)
    docs = documents(spark, SF).where(F.length("text") < 3000)
    known = spark.read.parquet(f"{SF}/labels.parquet").join(docs.select("doc_id"), "doc_id", "left_semi")
    train = known.withColumn("h", F.xxhash64("doc_id")).where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [(plain_features(text[r["doc_id"]]), r["quality"]) for r in train.orderBy("h").collect()]
    assert len(rows) > 20 and {y for _, y in rows} == {0, 1}
    w = plain_ftrl(rows)
    got = quality_classifier.query(spark, docs, known).collect()
    assert len(got) == len(text)
    for r in got:
        f = plain_features(text[r["doc_id"]])
        z = sum(k * w[i] for i, k in f.items()) / math.sqrt(max(1, f.total())) + w[quality_classifier.BUCKETS]
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-6
        assert r["predicted"] == (r["score"] >= 0.3)


def plain_logistic(x, y):
    """Weights by the same steps on one dense matrix (last column: the bias); L2 on features only."""
    t = toxicity
    w, m, s = (np.zeros(x[0].shape[1]) for _ in range(3))
    x, features = x
    for step in range(1, t.STEPS + 1):
        g = x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / len(y)
        g[:features] += t.L2 * w[:features]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w = w - t.RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w


def test_toxicity_is_the_plain_chain(spark):
    """Each link learned from features and out-of-fold probabilities of the links before it,
    and scored with the probabilities of the links fitted on all rows."""
    ship(spark)
    rng = np.random.default_rng(2)
    texts, flags = [], []
    for k in range(160):
        toxic = k % 4 == 0
        more = [["vile", "awful"], ["grim", "nasty"]][k % 8 // 4] if toxic else []
        texts.append(" ".join("word" + "abcdefghij"[i] * 2 for i in rng.integers(0, 10, 6)) + " " + " ".join(more))
        flags.append(toxic)
    lists, flags, fold = [toxicity.text_features(t) for t in texts], np.array(flags), np.arange(160) % toxicity.FOLDS
    model = toxicity.learn_chain(lists, flags, fold)
    assert len(model["markers"]) == 2
    names = model["features"]
    x = np.array([[float(f in r) for f in names] for r in map(set, lists)])
    targets = [flags & np.array([bool(set(g) & set(r)) for r in lists]) for g in model["markers"]] + [flags]
    oof = scored = np.zeros((160, 0))
    for y in targets:
        def wide(p):
            return np.hstack([x, p, np.ones((160, 1))])
        out = np.zeros(160)
        for k in range(toxicity.FOLDS):
            w = plain_logistic((wide(oof)[fold != k], len(names)), y[fold != k])
            out[fold == k] = 1 / (1 + np.exp(-(wide(oof)[fold == k] @ w)))
        w = plain_logistic((wide(oof), len(names)), y)
        p = 1 / (1 + np.exp(-(wide(scored) @ w)))
        oof, scored = np.hstack([oof, out[:, None]]), np.hstack([scored, p[:, None]])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: [*r["categories"], r["toxic_score"]] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert np.abs(np.array([got[i] for i in range(160)]) - scored).max() < 1e-4


def chained(kind, values):
    """The 64-bit hash of Spark's function over several values: each takes the last one's as its seed."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack(kind, v), seed=h)
    return h


def plain_fingerprint(text):
    f = fingerprints
    words = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
    if not words:
        return ""
    hashes = [chained("<Q", words[i:i + f.SHINGLE]) for i in range(max(1, len(words) - f.SHINGLE + 1))]
    bins = {}
    for h in hashes:
        b = h >> (64 - f.BIN_BITS)
        bins[b] = min(h, bins.get(b, M))
    digits = ""
    for i in range(f.BINS):
        tries = [i, *f._probe_order(i)[:f.PROBES]]
        b = next((b for b in tries if b in bins), None)
        if b is None:       # signed hashes of (bin, candidate)
            b = min(bins, key=lambda b: (chained("<i", (i, b)) + 2**63) & M)
        digits += "0123456789abcdef"[bins[b] & 15]
    return digits


def test_fingerprints_are_plain_one_permutation_minhash(spark, odd):
    texts = {r[1] for r in odd_rows()} | {r["text"] for r in documents(spark, SF).limit(40).collect()}
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    got = {r["text"]: r["f"] for r in rows.select("text", fingerprints.fingerprint(F.col("text")).alias("f")).collect()}
    assert got == {t: plain_fingerprint(t) for t in texts}
    a, b = sorted(t for t in texts if t and len(t) > 2000)[:2]
    pair = spark.createDataFrame([(got[a], got[b])], "a string, b string")
    agree = sum(x == y for x, y in zip(got[a], got[b])) / fingerprints.BINS
    assert abs(pair.select(fingerprints.likeness(F.col("a"), F.col("b"))).first()[0]
               - max(0.0, (agree - 1 / 16) / (1 - 1 / 16))) < 1e-12

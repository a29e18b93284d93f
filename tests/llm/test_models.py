"""Toxicity chain, quality classifier and language identification: held-out accuracy, odd documents."""
import numpy as np
from pyspark.sql import functions as F

from llm_rows import labels, none, odd, odd_rows  # noqa: F401
from pulsehouse.llm import language_id, quality_classifier, toxicity
from pulsehouse.llm.common import documents, ship

SF = "/root/testdata/sf0.01"


def test_profiles_rank_and_distance():
    g = language_id.grams("Aa b!")
    assert len(g) == 3 + 5 + 3          # letters; pairs with one blank around words; triples inside words
    p = language_id.Profiles({"x": language_id.ranked(*np.unique(language_id.grams("the then there"), return_counts=True)),
                              "y": language_id.ranked(*np.unique(language_id.grams("qu oi oui quoi"), return_counts=True))})
    assert p.predict("then the")[0] == "x" and p.predict("oui")[0] == "y"
    assert p.predict(None) == p.predict("12 !") == p.predict("") == ("und", 0.0)


def test_language_held_out_accuracy(spark, odd, none):
    ship(spark)
    docs = documents(spark, SF)
    rows = language_id.query(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98 and len(rows) > 100
    assert all(0 <= r["score"] <= 1 for r in rows)
    got = language_id.query(spark, odd).collect()
    assert len(got) == len(odd_rows()) and {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    blank = {r["doc_id"]: r["lang_pred"] for r in got}
    assert blank[0] == blank[3] == blank[6] == "und"
    assert language_id.query(spark, none).count() == 0


def test_quality_held_out_accuracy(spark, odd, labels, none):
    ship(spark)
    docs, known = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_classifier.query(spark, docs, known)
    assert rows.count() == docs.count()
    held = rows.join(known, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93 and len(held) > 50
    got = quality_classifier.query(spark, odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.query(spark, none, labels).count() == 0
    assert {r["score"] for r in quality_classifier.query(spark, odd, labels.limit(0)).collect()} == {0.5}


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    ship(spark)
    docs, known = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = known.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_classifier.learn(docs, x, "quality", ~fold) for x in (known, flipped))
    assert np.array_equal(a, b)


def test_ftrl_separates_and_is_sparse():
    rows = [np.array([1, 2, 3], np.uint32), np.array([7, 8, 9], np.uint32)] * 50
    w = quality_classifier.ftrl(rows, [1, 0] * 50)
    assert w[1] > 0 > w[8] and np.count_nonzero(w) <= 7


def test_chain_feeds_earlier_links_and_uses_out_of_fold_predictions():
    rng = np.random.default_rng(1)
    rows, flags = [], []
    for k in range(300):
        toxic = k % 4 == 0
        words = [f"w{x}" for x in rng.integers(0, 80, 12)] + (["vile", "awful"] if toxic and k % 8 else ["grim"] if toxic else [])
        rows.append(toxicity.text_features(" ".join(words).replace("w", "abcdefgh")))
        flags.append(toxic)
    model = toxicity.learn_chain(rows, np.array(flags), np.arange(300) % toxicity.FOLDS)
    assert len(model["links"]) == len(model["markers"]) + 1 >= 2
    for k, (w, v) in enumerate(model["links"]):
        assert len(w) == len(model["features"]) and len(v) == k + 1      # one weight per earlier link, and the bias
    assert abs(model["links"][-1][1][0]) > 0.1                            # the first category matters to the last link


def test_toxic_documents_are_caught_and_clean_ones_left(spark, odd, labels, none):
    ship(spark)
    docs, known = documents(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.learn(docs, known.where(~fold))
    held = known.where(fold).join(docs, "doc_id")
    rows = toxicity.score(held, model, ["doc_id", "toxic"]).collect()
    caught = [r["toxic_score"] >= toxicity.THRESHOLD for r in rows if r["toxic"] == 1]
    wrong = [r["toxic_score"] >= toxicity.THRESHOLD for r in rows if r["toxic"] == 0]
    assert np.mean(caught) > 0.8 and np.mean(wrong) < 0.01 and len(wrong) > 500
    got = toxicity.query(spark, odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["toxic_score"] <= 1 for r in got)
    assert toxicity.query(spark, none, labels).count() == 0
    assert {r["toxic"] for r in toxicity.query(spark, odd, labels.where("toxic = 0")).collect()} == {0}


def test_one_document_per_labelled_id_is_learned(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, f"good text {i}") for i in range(3000)] + [(2, "bad text"), (2, None)],
                                 "doc_id bigint, text string")
    known = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    learned = []
    once = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).limit(1).unionByName(
        docs.where("doc_id = 2").orderBy(F.xxhash64("text")).limit(1))
    for d in (docs, once):
        learned.append((quality_classifier.learn(d, known, "quality", F.lit(True)).tobytes(), toxicity.learn(d, known)))
    assert learned[0] == learned[1]

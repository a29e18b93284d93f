"""The pipeline's stages on odd documents and an empty table, and its run on the small tables."""
import glob
import importlib
import os
import random

import duckdb
import pyarrow as pa

import corpus_pipeline
from llm_rows import none, odd  # noqa: F401
from pulsehouse.llm import ngram_join, quality_rules, suffix_dedup
from pulsehouse.llm.common import documents, ship, written
from pulsehouse.session import checkpoint_root, conf_during
from test_near_duplicates import brute_components
from test_repeats import brute

SF = "/root/testdata/sf0.001"


def test_stages_take_odd_documents_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, SF), f"t-{name}")
            if name != "packing":
                assert out.columns == docs.columns, name
            if docs is none:
                assert out.count() == 0


def test_first_three_stages_are_brute_force(spark):
    ship(spark)
    docs = documents(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    rows = [r for r in con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if r[0] in kept]
    groups = brute_components(rows)
    rows = [r for r in rows if groups[r[0]] == r[0]]
    want = {r[0]: b[4].decode("utf-8", "ignore") for r, b in zip(rows, brute([r[1] for r in rows]))}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = written(stage(spark, docs, SF), f"t-{name}")
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want


def test_run_packs_what_the_mixture_holds(spark):
    out = importlib.import_module("__spark_entry__").queries()["pipeline"](spark, SF)
    rows = out.collect()
    assert rows and all(1 <= r["length"] <= 1024 for r in rows)
    assert "pipeline" not in importlib.import_module("__spark_entry__").oracle_sql()


def test_idle_workers_keep_no_tokenizer_after_packing(spark):
    import sys

    def held(batches):
        for b in batches:
            tokens = sys.modules.get("pulsehouse.llm.tokens")
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens.encoder.cache_info().currsize if tokens else 0] * b.num_rows, pa.int64())], ["n"])
    docs = spark.createDataFrame([(i, f"some words {i}", "en", "a", 12) for i in range(40)],
                                 "doc_id bigint, text string, lang string, source string, n_chars int").repartition(4)
    assert corpus_pipeline.sequences(spark, docs, None).count() == 40
    kept = spark.range(400).repartition(4).mapInArrow(held, "n bigint").agg({"n": "max"}).first()[0]
    assert kept == 0


def test_small_tables_are_written_in_few_files(spark):
    """However many partitions a shuffle has, a table of few rows is at most 16 files."""
    root, rng = checkpoint_root(spark).removeprefix("file:"), random.Random(3)
    passage = " ".join(rng.choices("abcdefgh", k=150))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + passage[:i % 3 * 150]) for i in range(60)]
    rows += [(100 + i, f"{t} end{i}") for i, t in rows[:40] for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    before = set(os.listdir(root))
    with conf_during(spark, spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false"):
        kept = ngram_join.keep_one(docs)
        assert {r["doc_id"] for r in kept.collect()} == {k for k, v in brute_components(rows).items() if k == v}
        got = {r["doc_id"]: r["text"] for r in suffix_dedup.strip(kept).collect()}
    texts = dict(rows)
    assert all((len(t) < len(texts[k])) == (k % 3 == 2) for k, t in got.items()) and len(got) == 60
    files = {d: len(glob.glob(f"{root}/{d}/part-*")) for d in set(os.listdir(root)) - before}
    assert {d.rsplit("-", 1)[0] for d in files} > {"classes", "groups", "star-links", "regions", "cut"}
    assert max(files.values()) <= 16, files

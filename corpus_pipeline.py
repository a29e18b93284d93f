"""The corpus pipeline: rules, near duplicates, repeated passages, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read back as the next
one's documents. All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsehouse.llm import mixing, ngram_join, packing, quality_rules, suffix_dedup
from pulsehouse.llm.common import documents, ship, written
from pulsehouse.session import prepare


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the strict policy of the rule ledger keeps."""
    return quality_rules.filter_documents(docs, "strict-1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 200 bytes that recur in what is left."""
    ship(spark)
    return suffix_dedup.strip(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target word counts, copies as separate rows."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences (with a smaller word cache that a worker gives
    back after each task: idle workers would keep it beside the next run's stages)."""
    ship(spark)
    return packing.query(spark, docs, cache_entries=400_000, keep_cache=False)


STAGES = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("packing", sequences),
]

#: SQL can't express the last three stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

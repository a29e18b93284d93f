"""The training-data queries: name -> (spark, sf_dir) -> DataFrame, and their SQL."""
from __future__ import annotations

from ..session import prepare
from . import (alignment, chat_format, fingerprints, language_id, mixing, ngram_join, packing, quality_classifier,
               quality_rules, suffix_dedup, target_sampling, token_output, toxicity)
from .common import ship


def _query(module, *tables, first="documents"):
    """The module's query over all documents (or another first table) and the named further tables."""
    def run(spark, sf_dir):
        prepare(spark)
        ship(spark)
        return module.query(spark, *[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in (first, *tables)])
    run.__name__, run.__doc__ = module.__name__.rpartition(".")[2], module.__doc__
    return run


QUERIES = {
    "op1_toxicity": _query(toxicity, "labels"),
    "op2_token_output": _query(token_output),
    "op3_ngram_join": _query(ngram_join),
    "op4_quality_classifier": _query(quality_classifier, "labels"),
    "op5_language_id": _query(language_id),
    "op6_suffix_dedup": _query(suffix_dedup),
    "op7_quality_rules": _query(quality_rules),
    "op8_fingerprints": _query(fingerprints),
    "op9_mixing": _query(mixing),
    "op10_packing": _query(packing),
    "op11_alignment": _query(alignment),
    "op12_target_sampling": _query(target_sampling, "benchmark"),
    "op13_chat_format": _query(chat_format, first="conversations"),
}

SQL = {
    "op7_quality_rules": quality_rules.SQL,
    "op13_chat_format": chat_format.SQL,
}

"""Queries over the shared test tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cleartab.llm import (best_fit, chat_format, collocations, hard_negatives, language, lexical_packing, line_dedup,
                          line_quality, mixing, ngram_join, secret_ledger, sharding, simhash, sql)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_ledger": secret_ledger.query,
    "op2_hash_tree_shards": sharding.query,
    "op3_simhash": simhash.query,
    "op4_lexical_packing": lexical_packing.query,
    "op5_systematic_mix": mixing.query,
    "op6_fuzzy_lines": line_dedup.query,
    "op7_word_backoff_language": language.query,
    "op8_prefix_tree_join": ngram_join.query,
    "op9_best_fit_packing": best_fit.query,
    "op10_line_labels": line_quality.query,
    "op11_chat_records": chat_format.query,
    "op12_threshold_negatives": hard_negatives.query,
    "op13_collocations": collocations.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = dict(sql.ORACLES)

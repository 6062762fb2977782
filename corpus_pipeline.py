"""From raw documents to packed training sequences.

Each stage takes (spark, docs, folder) and returns a table, which is written as
Parquet and read again as the next stage's documents. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.llm import language, lexical_packing, line_dedup, mixing, ngram_join
from cleartab.session import Staging, swept

NEAR_WORDS, NEAR_PERCENT = 5, 80
"""Texts are near copies when their sets of word 5-grams have a Jaccard similarity of 0.8 or more."""


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is recognised stay."""
    return language.accepted(docs, language.fit(docs, Staging(spark)))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated lines go, and with them documents that had nothing else."""
    rows = line_dedup.dedup(docs, Staging(spark))
    bare = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return rows.filter(~((F.col("n_dropped") > 0) & bare)).select(*[F.col(f"`{c}`") for c in docs.columns])


def join_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays; see ``NEAR_PERCENT``, op8's own threshold is another."""
    return ngram_join.representatives(docs, Staging(spark), NEAR_PERCENT, NEAR_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(spark, docs, Staging(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents by sequence and offset."""
    return lexical_packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("ngram_join", join_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over the documents of a folder. What a stage has staged goes when its output is
    written, and its input when the next one's is."""
    staging, before = Staging(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with swept():
            docs = staging.table(stage(spark, docs, sf_dir), name)
        if before:
            staging.drop(before)
        before = name
    return docs

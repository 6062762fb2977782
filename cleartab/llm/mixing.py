"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.common import WORD, documents, keep_only, numbered, unit_draw
from cleartab.session import Staging


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source: ``share`` of all sizes dealt by weight, no source above ``most`` times its size.

    ``sizes`` has one row (source, source_size) per source. Sources take the
    weights in turn, by code point, a null source last. What a full source
    leaves is dealt again among the others, until none is above: sorted by the
    level at which they fill up, a source is full when the level that spends
    everything reaches its own.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    rows = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most)
    rows = rows.withColumn("_level", F.col("_cap") / F.col("_weight"))
    up_to = Window.orderBy("_level", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.orderBy("_level", F.col("source").isNull(), "source").rowsBetween(1, Window.unboundedFollowing)
    spent = F.sum("_cap").over(up_to) + F.col("_level") * F.coalesce(F.sum("_weight").over(above), F.lit(0.0))
    rows = rows.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(share))
    rows = rows.withColumn("_full", spent <= F.col("_budget"))
    left = F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    heavy = F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything)
    rows = rows.withColumn("_dealt", left / heavy)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_dealt") * F.col("_weight")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def copies(rank: Column, expected: Column, offset: Column) -> Column:
    """Integer boundaries that the prefix sum of expected copies crosses at this rank."""
    return (F.floor(rank * expected + offset) - F.floor((rank - 1) * expected + offset)).cast("long")


def sample(spark: SparkSession, docs: DataFrame, staging: Staging, seed: str = "mix") -> DataFrame:
    """Copies of each document, so that every source meets its target.

    Size is the number of words; a null text has none. Within a source all
    documents expect the same number of copies, target over size of the source,
    so the prefix sum is rank times that number. Documents are ranked by size:
    one random offset then draws evenly from all sizes and the words taken stay
    within about one document of the target. The offset and the order of ties
    come from hashes, so reruns agree. A null source is a source. Repeated rows
    are ranked one by one. An empty table gives no rows; a source without words
    takes none.
    """
    rows = keep_only(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("tie"), *_marks())
    ranked = staging.table(numbered(rows, ["source"], ["size", "tie", "_a", "_b"], staging, "sized"), "ranked")
    sizes = ranked.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes)
    a, b = ranked.alias("a"), goals.alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        "a.doc_id", "a.source", "a.size", "a._a", "a._b", "a._rank", "b.source_size", "b.target")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_draw(F.lit(seed), F.coalesce(F.col("source"), F.lit("")))
    return rows.withColumn("copies", copies(F.col("_rank"), expected, offset)).drop("_rank")


def _marks() -> list[Column]:
    """128 bits that tell a row by its id, source and text; never null."""
    return [F.xxhash64("doc_id", "source", "text").alias("_a"), F.xxhash64("text", "source", "doc_id").alias("_b")]


def mixed(spark: SparkSession, docs: DataFrame, staging: Staging) -> DataFrame:
    """The documents themselves, each as often as the mix takes it. Equal rows share out their copies. Columns may
    have any names."""
    taken = sample(spark, docs, staging).groupBy("_a", "_b").agg(F.sum("copies").alias("_n"), F.count("*").alias("_k"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*names).alias("_row"), *_marks())
    turn = F.row_number().over(Window.partitionBy("_a", "_b").orderBy("_a"))
    rows = marked.join(taken.filter("_n > 0"), ["_a", "_b"]).withColumn("_turn", turn)
    rows = rows.withColumn("_copies", F.expr("_n div _k + int(_turn <= _n % _k)").cast("int"))
    repeat = F.explode(F.array_repeat(F.lit(0), F.col("_copies")))
    return rows.withColumn("_copy", repeat).select("_row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = sample(spark, documents(spark, folder), Staging(spark))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))

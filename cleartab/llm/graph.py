"""Connected components of very large graphs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleartab.session import Staging


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Every neighbour of a node is tied to the least node around it.

    ``edges`` has columns a > b. Large stars look at all neighbours and retie the
    larger ones, small stars look at the smaller ones and retie those and the
    node itself. Minimum and join are separate steps, so a node with very many
    neighbours is never gathered in one place.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    if large:
        tied = (both.join(least, "node").filter("other > node")
                .select(F.col("other").alias("a"), F.least("node", "least").alias("b")))
    else:
        tied = both.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        tied = tied.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return tied.filter("a <> b").distinct()


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(node, component) of all nodes with an edge; the component is its least node.

    ``edges`` has two whole-number columns a, b in any order; loops and repeats
    do no harm. Rounds go on until nothing changes, which takes about the
    logarithm of the longest path; each round is written, so lost executors
    cost at most one, and the round before it is deleted.
    """
    now = staging.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), f"{name}_0")
    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before, turn = mark(now), 0
    while before[0]:
        turn += 1
        now = staging.table(_stars(_stars(now, True), False), f"{name}_{turn}")
        after = mark(now)
        staging.drop(f"{name}_{turn - 1}")
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

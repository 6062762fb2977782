"""Sharding by a hierarchical weighted hash tree.

Shards are leaves of a tree of regions, racks and shards. A key descends it: at
each level every child draws -ln(u) / weight, with u from a hash of key and
child, and the least draw wins, so children are hit in proportion to their
weights. A draw depends on its own child only: changing a weight moves keys
solely into or out of the subtree that holds it; inside all other subtrees
nothing moves.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.llm.common import documents, keep_only, numbered, unit_draw
from cleartab.session import Staging


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def standard(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Leaf]:
    """Equal shards, filled rack by rack."""
    return [Leaf(i // (racks_per_region * shards_per_rack), i // shards_per_rack, i) for i in range(shards)]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own, so that keys only move into it."""
    new = Leaf(max(x.region for x in leaves) + 1, max(x.rack for x in leaves) + 1,
               max(x.shard for x in leaves) + 1, weight)
    return [*leaves, new]


def _least(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = [F.struct((-F.log(unit_draw(key, F.lit(level), F.lit(str(child)))) / F.lit(float(w))).alias("draw"),
                      F.lit(child).alias("child")) for child, w in sorted(weights.items())]
    return F.least(*draws)["child"]


def _sums(leaves: Iterable[Leaf], name: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for leaf in leaves:
        out[getattr(leaf, name)] = out.get(getattr(leaf, name), 0.0) + leaf.weight
    return out


def _branch(at: Column, choices: dict[int, Column]) -> Column:
    """The choice of the child that the key is at; only that branch is evaluated."""
    items = list(choices.items())
    out = F.when(at == items[0][0], items[0][1])
    for child, choice in items[1:]:
        out = out.when(at == child, choice)
    return out


def place(df: DataFrame, key: Column, leaves: list[Leaf], name: str) -> DataFrame:
    """Adds the shard of each key. A null key is a key like any other."""
    live = [x for x in leaves if x.weight > 0]
    if not live or len({x.shard for x in live}) < len(live):
        raise ValueError("shards need distinct numbers and some weight")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    df = df.withColumn("_region", _least(text, "region", _sums(live, "region")))
    racks = {r: _least(text, "rack", _sums([x for x in live if x.region == r], "rack"))
             for r in sorted({x.region for x in live})}
    df = df.withColumn("_rack", _branch(F.col("_region"), racks))
    shards = {r: _least(text, "shard", _sums([x for x in live if x.rack == r], "shard"))
              for r in sorted({x.rack for x in live})}
    return df.withColumn(name, _branch(F.col("_rack"), shards).cast("int")).drop("_region", "_rack")


def assign(spark: SparkSession, docs: DataFrame, leaves: list[Leaf], staging: Staging) -> DataFrame:
    """Shard, gapless slot in it and the shard after growth, for each document.

    Size is the number of UTF-8 bytes plus 1 and the checksum that of the bytes;
    a null text counts as none. Repeated rows each get a slot. Any further
    columns of the input are left out. An empty table gives no rows.
    """
    rows = keep_only(docs, "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = place(place(rows, F.col("doc_id"), leaves, "shard"), F.col("doc_id"), grown(leaves), "grown_shard")
    return (numbered(placed, ["shard"], ["doc_id", "text_crc32", "size"], staging, "placed")
            .withColumn("slot", F.col("_rank") - 1).drop("_rank"))


def write_shards(placed: DataFrame, docs: DataFrame, path: str) -> None:
    """The documents in one folder per shard, spread over as many tasks as there are rows to write."""
    rows = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartition("shard", (F.col("slot") / 50_000).cast("long")).write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = assign(spark, documents(spark, folder), standard(16), Staging(spark))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

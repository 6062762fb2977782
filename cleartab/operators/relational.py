"""Unions, set operations, joins and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column absent from one of them is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct keys of the left only. Both sides are made distinct first, so a key
    repeated a billion times crosses the shuffle once per task."""
    return left.distinct().subtract(right.distinct())


def key_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.distinct().intersect(right.distinct())


def left_join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left equi-join with the right key dropped. Which side is broadcast, if any,
    is left to Spark's size check."""
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def in_codes(df: DataFrame, column: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose code is in the set (made distinct before the join)."""
    keys = codes.select(F.col(code).alias("__code")).distinct()
    return df.join(keys, F.col(column) == F.col("__code"), "left_semi")


def not_in_codes(df: DataFrame, column: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose code is not in the set; a null code is kept."""
    keys = codes.select(F.col(code).alias("__code")).distinct()
    return df.join(keys, F.col(column) == F.col("__code"), "left_anti")


def nested_counts(df: DataFrame, selections: Mapping[str, Column]) -> DataFrame:
    """``(subset, n, n_outside)`` of selections that should each lie in the next:
    rows selected, and those of them that the next one lacks. One pass, one row per
    task in the shuffle."""
    names = list(selections)
    marked = df.select(*[F.coalesce(selections[n], F.lit(False)).alias(n) for n in names])
    sums = marked.agg(*[F.struct(
        F.lit(n).alias("subset"), F.count_if(n).alias("n"),
        F.count_if(F.col(n) & ~F.col(wider)).alias("n_outside")).alias(n)
        for n, wider in zip(names, [*names[1:], names[-1]])])
    return sums.select(F.inline(F.array(*names)))


def subset_violations(narrow: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """Keys of the narrow table that the wide one lacks (must be empty); for selections
    of one table see ``nested_counts``."""
    return narrow.select(key).join(wide.select(key), key, "left_anti")


def row_and_entity_counts(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Rows and distinct entities per group. The distinct step shuffles on group
    and entity together, so one huge group is spread over all tasks."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.count_distinct(entity).alias("n_entities"))


def entity_bitmaps(df: DataFrame, by: str, entity: str) -> DataFrame:
    """``(by, prefix, bucket, bits)``: the distinct entities of each group as bitmaps
    that can be put together without the rows they came from.

    The entity is a number or a text. The last six digits of a text of digits are
    a place in a bitmap, what stands before them (and their number) its prefix;
    any other text is a prefix of its own. Nothing is hashed, so counts are exact.
    Null entities are left out. A bucket holds 64 neighbouring numbers in one long,
    so an entity without neighbours takes no more than its own row.
    """
    text = F.col(entity).cast("string")
    digits = text.rlike(r"\A[0-9]+\z")
    head = F.when(digits, F.concat(F.length(text).cast("string"), F.lit(":"), F.substring(text, F.lit(1), F.length(text) - 6)))
    tail = F.when(digits, F.right(text, F.lit(6)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    rows = df.filter(F.col(entity).isNotNull()).select(by, F.coalesce(head, F.concat(F.lit("t"), text)).alias("prefix"), tail.alias("tail"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("tail") % 64).cast("int"))
    return (rows.select(by, "prefix", F.shiftright("tail", 6).alias("bucket"), bit.alias("bit"))
            .groupBy(by, "prefix", "bucket").agg(F.bit_or("bit").alias("bits")))


def entities_in(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct entities of the given groups, or of all: bitmaps of one bucket are
    united, then their bits are counted."""
    united = bitmaps.groupBy(*by, "prefix", "bucket").agg(F.bit_or("bits").alias("bits"))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("n_entities"))

"""Helpers shared by the operators: staged tables, order numbers, word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.session import Staging

BLANKS = r"\x20\x09-\x0D"
"""Word separators: space and the five ASCII control blanks."""
WORD = rf"[^{BLANKS}]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def keep_only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever else (clashing names included) the table holds."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def whole_text(df: DataFrame) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text without empty entries."""
    return F.filter(F.split(text, rf"[{BLANKS}]+"), lambda w: w != "")


def unit_draw(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone; 52 bits of an md5, which any SQL engine has."""
    digest = F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def in_stretches(df: DataFrame, order: list[Column], staging: Staging, name: str) -> DataFrame:
    """The rows, staged, cut into stretches ``_part`` of the given order.

    Range partitioning samples the keys, so stretches are even whatever the
    values are; writing them fixes the cut for everything that follows.
    """
    return staging.table(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)


def numbered(df: DataFrame, groups: list[str], order: list[str], staging: Staging, name: str) -> DataFrame:
    """Adds ``_rank``: 1, 2, ... within each group in the given order, nulls first.

    A group may hold any share of the rows: it is numbered stretch by stretch,
    and only one count per stretch and group is summed up in front of it.
    """
    cut = in_stretches(df, [F.col(c) for c in groups + order], staging, name)
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy("_part", *groups).agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    inside = Window.partitionBy("_part", *groups).orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(inside).cast("long"))
    a, b = ranked.alias("a"), offsets.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for g in groups:
        same &= F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return a.join(b, same).select(
        *[F.col(f"a.{c}") for c in df.columns], (F.col("a._rank") + F.col("b._before")).alias("_rank"))

"""Latest version of each record, and names learned from the records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleartab.functions import lists


def _tie_break(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """128 bits that differ where the other columns do; maps are compared as text."""
    others = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`")
              for c, t in df.dtypes if c not in keys]
    # Which columns are null is hashed as well: a hash alone passes over nulls.
    absent = [F.col(f"`{c}`").isNull() for c in df.columns if c not in keys]
    if not others:
        return []
    return [F.xxhash64(*others, *absent).desc(), F.xxhash64(F.lit(1), *others, *absent).desc()]


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   scanned: bool = False) -> DataFrame:
    """One row per key: the first under ``order``, then by hashes of all other
    columns, so a tie never depends on how the data is split and the sort carries
    two numbers, not the row's texts. The rows that tie for the first place of a key
    are the only ones hashed; both steps share one shuffle.

    Rows with a null key are separate records and all stay; collapsing them would
    lose rows and put them all into one task. The rank limit is applied before
    the shuffle, so each map task sends at most one row per key.

    By default the null-key rows take their own branch, a second scan that a
    columnar source mostly skips by its statistics. ``scanned`` says that ``df``
    is read straight from files, whose row order is fixed: the rows are then
    numbered instead, and text sources are read and parsed only once.
    """
    rest = _tie_break(df, keys)
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()

    def first(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        # Rows that tie on the order come through the first limit together; only these are hashed.
        same = Window.partitionBy(*by).orderBy(*order)
        tied = rows.withColumn("__rank", F.rank().over(same)).filter("__rank = 1")
        one = Window.partitionBy(*by).orderBy(*(rest or order))
        return tied.withColumn("__rank", F.row_number().over(one)).filter("__rank = 1").drop("__rank")

    if scanned:
        number = F.when(unknown, F.monotonically_increasing_id()).otherwise(F.lit(-1))
        return first(df.withColumn("__number", number), [*keys, "__number"]).drop("__number")
    return first(df.filter(~unknown), keys).unionAll(df.filter(unknown))


def learn_names(pairs: DataFrame, code: str = "code", name: str = "name") -> DataFrame:
    """Smallest name per code.

    Equal pairs are merged by hash before the shuffle, so the minimum (which
    Spark takes over sorted rows when it is a text) sees few rows, and a code
    that fills a third of them is spread by its names.
    """
    known = pairs.filter(F.col(code).isNotNull()).select(code, name).distinct()
    return known.groupBy(code).agg(F.min(name).alias(name))


def pairs_from_lists(df: DataFrame, codes: Column, names: Column) -> DataFrame:
    """Code and name side by side, only from rows where both lists agree in length.
    The test is part of the projection; as a filter it would be pushed below and
    compute both lists twice."""
    rows = df.select(codes.alias("c"), names.alias("n"))
    agree = F.size("c") == F.size("n")
    return rows.select(lists.unnest(F.when(agree, F.col("c")), F.when(agree, F.col("n")),
                                    ("code", "name")))


def name_lists(df: DataFrame, key: str, codes: str, names: DataFrame, prefix: str, into: str) -> DataFrame:
    """Replace a list of codes by their joined names, in the list's order.

    ``names(code, name)`` is a table of any size: the codes are exploded, joined
    by code (Spark decides on a broadcast, a frequent code is split at run time)
    and put together again; ``key`` must identify the row.
    """
    items = df.select(key, F.posexplode(codes).alias("__pos", "__code"))
    decoded = (items.join(names.select(F.col("code").alias("__code"), "name"), "__code", "left")
               .withColumn("name", F.coalesce("name", F.concat(F.lit(prefix), F.col("__code").cast("string")))))
    # One list per row of the input, no longer than the list it came from.
    joined = (decoded.groupBy(key)
              .agg(F.sort_array(F.collect_list(F.struct("__pos", "name"))).alias("__l"))
              .select(key, lists.join_list(F.transform("__l", lambda s: s["name"])).alias(into)))
    return df.join(joined, key, "left")

"""Cutting a raw table into slices, and checking that every row was loaded."""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleartab.functions.search import at_or_below
from cleartab.session import Staging

# Rows from which a slice is split further, and the first year of
# the second time column.
MONTH_SPLIT = 10_000
RESIDUAL_SPLIT = 20_000
RESIDUAL_FIRST_YEAR = 2020


def bounds(prefix: str) -> tuple[str, str]:
    """Half-open text range ``[from, to)`` of a year (4) or month (6) prefix."""
    if len(prefix) == 4:
        return prefix, f"{int(prefix) + 1:04d}"
    year, month = divmod(int(prefix[:4]) * 12 + int(prefix[4:]), 12)
    return prefix, f"{year:04d}{month + 1:02d}"


def in_slice(col: Column, prefix: str) -> Column:
    """Text comparison, as the column mixes formats."""
    low, high = bounds(prefix)
    return (col >= low) & (col < high)


def segments(prefixes: Sequence[str]) -> tuple[list[str], list[str | None]]:
    """Ascending bounds of all slices, and which slice holds from each bound to the
    next: of slices that overlap, the first listed; null between slices."""
    spans = [(*bounds(p), i) for i, p in enumerate(prefixes)]
    spans = [(low, high, i) for low, high, i in spans if low < high]
    cuts = sorted({x for low, high, _ in spans for x in (low, high)})
    starting = sorted(spans)
    held, holders, at = [], [], 0
    for cut in cuts:
        while at < len(starting) and starting[at][0] <= cut:
            heapq.heappush(held, (starting[at][2], starting[at][1]))
            at += 1
        while held and held[0][1] <= cut:
            heapq.heappop(held)
        holders.append(prefixes[held[0][0]] if held else None)
    return cuts, holders


def slice_of(col: Column, prefixes: Sequence[str]) -> Column:
    """The slice that holds a value, null for none. The bounds are one sorted array
    that is halved for each row, however many slices there are."""
    cuts, holders = segments(prefixes)
    if not cuts:
        return F.lit(None).cast("string")
    texts = lambda x: F.from_json(F.lit(json.dumps(x)), "array<string>")  # noqa: E731  one literal, folded once
    at = at_or_below(texts(cuts), col)
    return F.when(at > 0, F.get(texts(holders), at - 1))


def residual(col: Column, covered: Sequence[str]) -> Column:
    """True for values in none of the covered slices, nulls included."""
    return slice_of(col, covered).isNull()


def selected(codes: Column, wanted: Sequence[int], excluded: Sequence[int]) -> Column:
    """A list holding a wanted code and none of the excluded; a null list is not
    selected."""
    clean = F.array_compact(codes)

    def overlap(values):
        return F.arrays_overlap(clean, F.array(*[F.lit(v) for v in values]))

    keep = overlap(wanted)
    return F.coalesce(keep & ~overlap(excluded) if excluded else keep, F.lit(False))


def slice_counts(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows per slice. The slice is computed on the row and counted before the
    shuffle; a row in no slice is not counted and empty slices are kept as 0."""
    counts = (df.select(slice_of(F.col(column), prefixes).alias("slice")).filter(F.col("slice").isNotNull())
              .groupBy("slice").agg(F.count(F.lit(1)).alias("n")))
    listed = df.sparkSession.createDataFrame([(p,) for p in prefixes], "slice string")
    return listed.join(counts, "slice", "left").select(
        "slice", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def slice_plan(df: DataFrame, year: Column, month: Column, area: Staging, split: int = MONTH_SPLIT,
               total: int | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """Year slices, and month slices for the years with ``split`` rows or more.

    One pass counts by year and month; the few counts are staged and all later
    steps see only those. Empty slices vanish, as long as the counts can be
    trusted. When the dated rows are fewer than half of all rows (or of the
    declared ``total``), they cannot: every year of ``years`` (else of the dated
    range) is kept whole, empty ones too. A table with fewer than ``split`` rows
    is not cut: its years stay whole, all of ``years`` where they are given.
    Where the months of a year are fewer than half of it, all twelve are kept.
    """
    spark = df.sparkSession
    counts = area.table(df.groupBy(year.cast("int").alias("y"), month.cast("int").alias("m"))
                        .agg(F.count(F.lit(1)).alias("n")), f"counts-{uuid.uuid4().hex}")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      F.coalesce(F.sum(F.when(F.col("y").isNotNull(), F.col("n"))), F.lit(0)).alias("dated"),
                      F.min("y").alias("low"), F.max("y").alias("high")).first()
    declared = sums.n if total is None else total
    by_year = counts.filter("y is not null").groupBy("y").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("m").isNotNull(), F.col("n"))), F.lit(0)).alias("in_months"))
    named = F.col("y").cast("string")
    if sums.dated * 2 < declared or declared < split and years:
        first, last = years or (sums.low, sums.high)
        if first is None:
            return spark.createDataFrame([], "slice string, n bigint")
        every = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
        return every.join(by_year, "y", "left").select(named.alias("slice"), F.coalesce("n", F.lit(0)).alias("n"))
    if declared < split:
        return by_year.select(named.alias("slice"), "n")
    monthly = F.col("n") >= split
    twelve = F.explode(F.sequence(F.lit(1), F.lit(12)))
    months = by_year.filter(monthly).withColumn("m", twelve).select("y", "m", (F.col("in_months") * 2 < F.col("n")).alias("all"))
    months = (months.join(counts.filter("y is not null and m is not null"), ["y", "m"], "left")
              .filter(F.col("all") | F.col("n").isNotNull())
              .select(F.concat(named, F.lpad(F.col("m").cast("string"), 2, "0")).alias("slice"),
                      F.coalesce("n", F.lit(0)).alias("n")))
    return by_year.filter(~monthly).select(named.alias("slice"), "n").unionByName(months)


def residual_slices(rows: DataFrame, second: Column, split: int = RESIDUAL_SPLIT,
                    first_year: int = RESIDUAL_FIRST_YEAR) -> DataFrame:
    """Name the slice of each residual row: one slice for few rows, else one per
    year of a second date. Rows whose second date is unknown or too early stay in
    the plain slice, so none is lost. The total comes from an aggregate, not
    from a window over all rows."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    year = F.year(second)
    key = F.when((n >= split) & (year >= first_year),
                 F.concat(F.lit("residual_"), year.cast("string"))).otherwise(F.lit("residual"))
    return rows.withColumn("slice", key)


def plan_drift(recorded: DataFrame, planned: DataFrame, column: str = "slice") -> DataFrame:
    """Slices of an earlier plan that the new plan lacks; any row means "stop"."""
    return recorded.select(column).subtract(planned.select(column))


def reconcile(loaded: DataFrame, declared: DataFrame, unit: str, n: str = "n") -> DataFrame:
    """Loaded against declared rows per unit; complete only when they are equal.
    ``loaded`` has one row per record, ``declared`` one per unit and observation,
    of which the highest counts."""
    have = loaded.groupBy(unit).agg(F.count(F.lit(1)).alias("n_loaded"))
    want = high_water(declared, unit, n).withColumnRenamed("n_max", "n_declared")
    both = have.join(want, unit, "full_outer")
    zero = F.lit(0).cast("bigint")
    loaded_n, declared_n = F.coalesce("n_loaded", zero), F.coalesce("n_declared", zero)
    return both.select(unit, loaded_n.alias("n_loaded"), declared_n.alias("n_declared"),
                       (declared_n - loaded_n).alias("diff"),
                       (F.col("n_declared").isNotNull() & (loaded_n == declared_n)).alias("complete"))


def high_water(observed: DataFrame, unit: str, n: str = "n") -> DataFrame:
    """Highest total ever reported per unit."""
    return observed.groupBy(unit).agg(F.max(n).cast("bigint").alias("n_max"))

"""Order-dependent operators that never put one whole group into one task.

A window partitioned by the group alone would sort a group holding a third of
all rows in a single task. Here the numeric order column is cut into stretches
that hold about equally many rows, wherever its values lie; work inside a
stretch is a window on (group, stretch), and what passes from one stretch to the
next is a running value over one summary row per stretch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleartab.functions.search import at_or_below
from cleartab.session import Staging

STRETCH_ROWS = 1 << 16
"""Rows that a stretch should span when all rows are one group."""
QUANTILES = 4096
"""Cuts that the sketch of the order column offers; there are no more stretches than that."""


def boundaries(df: DataFrame, order: str, rows: int = STRETCH_ROWS) -> Column:
    """Ascending values of the order column with about ``rows`` rows between them,
    from one mergeable quantile sketch; no values when the table is small. A far
    value moves no boundary, as ranks count and not distances."""
    value = F.col(order).cast("double")
    n = F.least(F.ceil(F.count(order) / F.lit(rows)), F.lit(QUANTILES)).cast("int")
    shares = F.from_json(F.lit(json.dumps([i / QUANTILES for i in range(1, QUANTILES)])), "array<double>")  # one literal
    sketch = F.approx_percentile(value, shares, 8 * QUANTILES)
    cuts = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.col("q")[(i * QUANTILES / F.col("n")).cast("int") - 1])
    return (df.agg(n.alias("n"), sketch.alias("q"))
            .select(F.when(F.col("n") > 1, F.array_distinct(cuts)).otherwise(F.array().cast("array<double>"))).scalar())


def _stretched(df: DataFrame, order: str, stretch: float | None, rows: int) -> DataFrame:
    """Number of the stretch of each row, found among the boundaries by halving; with
    a given width the stretches are even instead."""
    if stretch is not None:
        return df.withColumn("__stretch", F.floor(F.col(order) / F.lit(stretch)))
    cut = df.withColumn("__bounds", boundaries(df, order, rows))
    return cut.withColumn("__stretch", at_or_below(F.col("__bounds"), F.col(order).cast("double"))).drop("__bounds")


def numbered(df: DataFrame, order: Sequence[Column], into: str, area: Staging) -> DataFrame:
    """1, 2, 3 ... over all rows in order.

    Rows are sorted by range over the tasks and written with their place in the
    partition; the rows of the partitions before are summed up over one count per
    partition. Ties are numbered as they come to lie.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    cut = area.table(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__part"), place.alias("__at")), f"numbered_{into}")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (cut.join(offsets, "__part").withColumn(into, F.col("__at") + F.col("__before") + 1)
            .drop("__part", "__at", "__before"))


def _earlier(groups: Sequence[str]):
    return (Window.partitionBy(*groups).orderBy("__stretch")
            .rowsBetween(Window.unboundedPreceding, -1))


def _up_to_here(groups: Sequence[str], order: str):
    """Rows of one stretch in order, after the carry row that opens it."""
    return (Window.partitionBy(*groups, "__stretch").orderBy("__row", order)
            .rowsBetween(Window.unboundedPreceding, 0))


def _opened_by(rows: DataFrame, carries: DataFrame) -> DataFrame:
    """Put each stretch's carry row (``__row`` 0) in front of its rows (``__row`` 1).
    A union and not a join, so the rows are shuffled once, for the window."""
    return rows.withColumn("__row", F.lit(1)).unionByName(
        carries.withColumn("__row", F.lit(0)), allowMissingColumns=True)


def forward_fill(df: DataFrame, groups: Sequence[str], order: str, value: Column, reset: Column,
                 into: str, stretch: float | None = None, rows: int = STRETCH_ROWS) -> DataFrame:
    """Last non-null text value in order; a reset row clears it for the rows from
    there on until the next value."""
    cleared = F.struct(F.lit(None).cast("string").alias("v"))
    marked = _stretched(df, order, stretch, rows).withColumn(
        "__mark", F.when(F.coalesce(reset, F.lit(False)), cleared)
        .when(value.isNotNull(), F.struct(value.cast("string").alias("v"))))
    summary = marked.groupBy(*groups, "__stretch").agg(
        F.max(F.when(F.col("__mark").isNotNull(),
                     F.struct(F.col(order).alias("at"), F.col("__mark").alias("mark"))))
        .alias("__last"))
    carries = summary.select(
        *groups, "__stretch",
        F.last(F.col("__last")["mark"], ignorenulls=True).over(_earlier(groups)).alias("__mark"))
    seen = F.last("__mark", ignorenulls=True).over(_up_to_here(groups, order))
    return (_opened_by(marked, carries).withColumn(into, seen["v"]).filter("__row = 1")
            .drop("__stretch", "__mark", "__row"))


def occurrence_number(df: DataFrame, groups: Sequence[str], order: str, into: str,
                      stretch: float | None = None, rows: int = STRETCH_ROWS) -> DataFrame:
    """1, 2, 3 ... within each group by the order column."""
    keyed = _stretched(df, order, stretch, rows)
    counts = keyed.groupBy(*groups, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    carries = counts.select(
        *groups, "__stretch",
        F.coalesce(F.sum("__n").over(_earlier(groups)), F.lit(0)).alias("__step"))
    running = F.sum("__step").over(_up_to_here(groups, order))
    steps = keyed.withColumn("__step", F.lit(1).cast("bigint"))
    return (_opened_by(steps, carries).withColumn(into, running).filter("__row = 1")
            .drop("__stretch", "__step", "__row"))


def latest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """The n latest distinct periods: reduced to distinct values first, so no
    global sort of the rows. At most n rows."""
    return df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)


def in_latest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the n latest periods (the join side holds at most n rows)."""
    recent = latest_periods(df, period, n)
    return df.join(F.broadcast(recent), period, "left_semi")

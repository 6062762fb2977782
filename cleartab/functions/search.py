"""Binary search inside a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_or_below(bounds: Column, value: Column) -> Column:
    """How many of the ascending ``bounds`` are at or below the value, by halving
    the array: 14 steps for 10,000 bounds. A null value is below all of them."""
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        open_ = s["low"] < s["high"]
        right = open_ & F.coalesce(F.get(bounds, middle) <= value, F.lit(False))
        return F.struct(F.when(right, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(open_ & ~right, middle).otherwise(s["high"]).alias("high"))

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(bounds))))
    return F.reduce(steps, start, halve, lambda s: s["low"])

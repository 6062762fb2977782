"""Sets of 64-bit keys as bitmaps of one fixed size.

A bitmap never misses a key; it lets some others through, which costs time and is
mended by whatever exact step follows. Its size does not grow with the data, so it
can be sent to every task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
"""A set takes 2^BITS bits (8 MB), however many keys there are."""


class Bitmap:
    """A set of keys in 2^BITS bits; never misses a key."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << (BITS - 6), np.uint64) if bits is None else bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(64 - BITS)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)

    @classmethod
    def of(cls, keys: DataFrame) -> Bitmap:
        """Of the column ``key``. At most 2^(BITS - 6) rows come to the driver, whatever the number of keys."""
        slot = F.shiftrightunsigned("key", 64 - BITS)
        bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
        rows = (keys.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("word"), bit.alias("bit"))
                .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
        out = cls()
        out.bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return out

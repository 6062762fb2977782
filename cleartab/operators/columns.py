"""Projection and schema operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ensure_columns(df: DataFrame, expected: Sequence[str], dtype: str = "string") -> DataFrame:
    """Add the expected columns an older layout lacks, as typed nulls. Names are
    compared as Spark resolves them, without case."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in dict.fromkeys(expected) if c.lower() not in present]
    return df.select("*", *[F.lit(None).cast(dtype).alias(c) for c in missing])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def strip_prefix(df: DataFrame, columns: Sequence[str], length: int) -> DataFrame:
    """Rename the columns to themselves without their first characters."""
    return df.withColumnsRenamed({c: c[length:] for c in columns})


def subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def drop(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an empty one of the same schema when a required column
    is missing."""
    return df if {c.lower() for c in required} <= {c.lower() for c in df.columns} else df.limit(0)


def unlisted_columns(df: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Report of the columns a dictionary does not name."""
    names = sorted(set(df.columns) - set(listed))
    return df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")


def keep_listed(df: DataFrame, listed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with the listed columns only, and of the columns left out how much
    they hold: ``(column_name, n_rows, n_filled)``, one pass and one row per task."""
    names = sorted(set(df.columns) - set(listed))
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c in set(listed)])
    if not names:
        return kept, df.sparkSession.createDataFrame([], "column_name string, n_rows bigint, n_filled bigint")
    counts = df.agg(*[F.struct(F.lit(n).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
                               F.count(F.col(f"`{n}`")).alias("n_filled")).alias(f"c{i}") for i, n in enumerate(names)])
    return kept, counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(names))])))

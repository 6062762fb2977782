"""Code decoding and classification rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleartab.functions.text import full_match

def literal_map(book: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(book.items())])


def lookup(col: Column, book: Mapping, missing: str = "null", default=None) -> Column:
    """Decode a column with a small codebook.

    ``missing`` says what an unlisted code becomes: ``null``, ``keep`` (the code
    itself) or ``default`` (a value or column).
    """
    found = F.try_element_at(literal_map(book), col)
    if missing == "null":
        return found
    if missing == "keep":
        return F.coalesce(found, col)
    if missing == "default":
        return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
    raise ValueError(f"unknown rule for missing codes: {missing}")


def lookup_table(df: DataFrame, column: str, book: DataFrame, code: str, label: str,
                 into: str, missing: str = "null") -> DataFrame:
    """Decode with a codebook that is itself a table: a left join on the code.

    No broadcast is forced: Spark broadcasts the book when its size allows and
    otherwise joins by shuffling, with skewed codes split at run time. The book
    is reduced to one label per code, so no row can be doubled.
    """
    unique = book.groupBy(F.col(code).alias("__code")).agg(F.min(label).alias("__label"))
    joined = df.join(unique, F.col(column) == F.col("__code"), "left")
    value = F.col("__label") if missing == "null" else F.coalesce("__label", column)
    return joined.withColumn(into, value).drop("__code", "__label")


def decode(df: DataFrame, books: Mapping[str, Mapping], missing: str = "keep") -> DataFrame:
    """Decode many columns in one projection. Books stand in the code and are
    literal whatever their length; a book read from data is joined (``lookup_table``)."""
    return df.select(*[
        lookup(F.col(f"`{c}`"), books[c], missing).alias(c) if books.get(c) else F.col(f"`{c}`")
        for c in df.columns])


def not_equal_or_null(col: Column, value) -> Column:
    """Drop the value, keep nulls (plain ``!=`` would lose them)."""
    return ~col.eqNullSafe(F.lit(value))


def any_marked(columns: Sequence[str], mark: str = "1") -> Column:
    """Three-valued OR: true, false, or null when nothing decides."""
    return reduce(or_, [F.col(c) == mark for c in columns])


def flag(condition: Column) -> Column:
    """A condition with "unknown" counted as no."""
    return F.coalesce(condition, F.lit(False))


def three_state(yes: Column, answered: Column, labels: tuple[str, str] = ("SIM", "NAO")) -> Column:
    """Yes when a criterion holds, no when a supporting field was answered, else
    null: "cannot tell" is not "no"."""
    return F.when(yes, F.lit(labels[0])).when(answered, F.lit(labels[1]))


def answered(columns: Sequence[str], values: Sequence[str] = ("1", "2")) -> Column:
    return reduce(or_, [F.col(c).isin(list(values)) for c in columns])


def outcome(attempt: Column, death: Column) -> Column:
    """An attempt marker wins; death needs a positive sign; otherwise unknown."""
    return F.when(attempt, F.lit("TENTATIVA")).when(death, F.lit("CONSUMADO"))


def age_in_years(col: Column, limit: int = 120) -> Column:
    """Unit digit and three-digit value: unit 4 counts years (null above the
    limit), units 1-3 are below one year, malformed codes are null."""
    years = F.substring(col, 2, 3).try_cast("int")
    unit = F.substring(col, 1, 1)
    return F.when(full_match(col, "[1-4][0-9]{3}"),
                  F.when(unit != "4", F.lit(0)).when(years <= limit, years))


def split_code(col: Column, heads: Mapping[str, str], tails: Mapping[str, str],
               other_heads: Sequence[str], other_tails: Mapping[str, str],
               width: int = 3) -> tuple[Column, Column, Column]:
    """Head label, then the tail decoded by one of two exclusive books depending
    on the head."""
    head = F.substring(col, 1, width)
    tail = F.substring(col, width + 1, 1)
    special = head.isin(list(other_heads))
    return (
        lookup(head, heads),
        F.when(~special, lookup(tail, tails)),
        F.when(special, lookup(tail, other_tails)),
    )

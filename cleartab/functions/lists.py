"""Rules on lists held in one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleartab.functions.codes import literal_map


def marked_labels(options: Mapping[str, str], mark: str = "1") -> Column:
    """Sorted distinct labels of the option columns that hold the mark.

    Sorting and merging columns of one label happen on the option list, once, so
    a row only drops the labels it lacks. Nothing marked gives an empty list.
    """
    columns: dict[str, list[str]] = {}
    for column, label in options.items():
        columns.setdefault(label, []).append(column)
    hits = [F.when(reduce(or_, [F.col(c) == mark for c in columns[label]]), F.lit(label))
            for label in sorted(columns, key=str.encode)]
    return F.array_compact(F.array(*hits))


def list_size(col: Column) -> Column:
    """Length with null for a null list, whatever the ANSI setting."""
    return F.when(col.isNotNull(), F.size(col))


def join_list(col: Column, separator: str = ", ") -> Column:
    """Join skipping nulls; an empty or all-null list gives null."""
    return F.when(F.exists(col, lambda x: x.isNotNull()), F.array_join(col, separator))


def has_any(col: Column, wanted: Sequence) -> Column:
    """Overlap flag: nulls inside the list count as "no match", a null list as unknown."""
    overlap = F.arrays_overlap(col, F.array(*[F.lit(w) for w in wanted]))
    return F.when(col.isNotNull(), F.coalesce(overlap, F.lit(False)))


def distinct_sorted_text(col: Column, separator: str = ", ") -> Column:
    """Distinct codes in their own order (numeric for numbers), as text."""
    ordered = F.sort_array(F.array_distinct(col))
    return join_list(F.transform(ordered, lambda x: x.cast("string")), separator)


def by_priority(codes: Column, priorities: Mapping[int, int], last: int = 99) -> Column:
    """Distinct codes ordered by priority, then by where they first appear.

    ``array_distinct`` keeps the first occurrence, so its index stands for the
    first position and the work stays linear in the length of the list.
    """
    rank = literal_map(priorities)
    firsts = F.array_compact(F.array_distinct(codes))
    keyed = F.transform(firsts, lambda x, i: F.struct(
        F.coalesce(F.try_element_at(rank, x), F.lit(last)).alias("priority"),
        i.alias("position"), x.alias("code")))
    return F.transform(F.sort_array(keyed), lambda s: s["code"])


def named(codes: Column, names: Column, prefix: str) -> Column:
    """Each code's name from a map column, else the prefix and the code."""
    return F.transform(codes, lambda x: F.coalesce(
        F.try_element_at(names, x), F.concat(F.lit(prefix), x.cast("string"))))


def unnest(left: Column, right: Column, names: tuple[str, str]) -> Column:
    """Two lists unnested side by side into two columns, the shorter padded with
    nulls; a null list gives no rows."""
    return F.inline(F.arrays_zip(left, right)).alias(*names)


def any_equal(columns: Sequence[str], value: str) -> Column:
    """True when any column equals the value; null counts as "no"."""
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.col(column).eqNullSafe(F.lit(value))
    return hit


def any_in(columns: Sequence[str], values: Sequence[str]) -> Column:
    """True when any column holds one of the values; null counts as "no"."""
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return hit

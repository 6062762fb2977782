"""Text and number rules on columns (all evaluated in the JVM)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value" after a cast to text.
NULL_TEXTS = ["nan", "NaN", "NaT", "None", "", "<NA>"]

_BLANKS = " \t\n\r\f\x0b"
_EMPTY_NAME = "coluna"


def full_match(col: Column, pattern: str) -> Column:
    r"""Whole-value regex test. ``\z`` and not ``$``: ``$`` also matches before a
    final line break."""
    return col.rlike(rf"\A(?:{pattern})\z")


def strip(col: Column) -> Column:
    """Remove blanks of any kind at both ends."""
    return F.trim(col, F.lit(_BLANKS))


def zero_pad(col: Column, width: int) -> Column:
    """Left-pad with zeros, leaving longer values whole (``lpad`` would cut them)."""
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def strip_leading_zeros(col: Column, blank_as_null: bool = False) -> Column:
    """``007`` -> ``7``, ``000`` -> ``0``; a blank becomes ``0`` or null."""
    bare = F.ltrim(col, F.lit("0"))
    if blank_as_null:
        return F.when(col == "", F.lit(None)).when(bare == "", F.lit("0")).otherwise(bare)
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def clean_text(col: Column) -> Column:
    """One space for every run of white space, none at the ends; null -> ``''``."""
    spaced = F.regexp_replace(col, "(?U)[\\s\\x1c-\\x1f]+", " ")
    return F.coalesce(F.trim(spaced), F.lit(""))


def drop_cross_reference(col: Column) -> Column:
    """Remove notes such as ``(Ver VD_IDADE)`` from a description."""
    return clean_text(F.regexp_replace(clean_text(col), "\\(\\s*[Vv]er[^)]*\\)", ""))


def slug_name(text: str) -> str:
    """Plain-Python slug for the few column names built on the driver."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "_", bare.lower()).strip("_") or _EMPTY_NAME


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """Latin letters by compatibility decomposition: 1:1 pairs for ``translate``
    and the rare characters that expand to several."""
    source, target, several = [], [], {}
    for point in [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0),
                  *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        char = chr(point)
        bare = "".join(c for c in unicodedata.normalize("NFKD", char)
                       if not unicodedata.combining(c))
        if bare == char or not re.search("[A-Za-z0-9]", bare):
            continue
        if len(bare) == 1:
            source.append(char)
            target.append(bare)
        else:
            several[char] = bare
    return "".join(source), "".join(target), several


def _character_class(characters: Iterable[str]) -> str:
    """A regex class of ranges; one of many single characters is searched slowly."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, characters)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def fold_accents(col: Column) -> Column:
    """Letters without their accents. Plain ASCII values are left as they are, and
    the long chain of replacements runs only for rows that need it."""
    source, target, several = _decompositions()
    expanded = col
    for char, bare in several.items():
        expanded = F.replace(expanded, F.lit(char), F.lit(bare))
    whole = F.when(col.rlike(_character_class(several)), expanded).otherwise(col)
    bare = F.regexp_replace(F.translate(whole, source, target), "\\p{M}+", "")
    return F.when(col.rlike("[^\\x00-\\x7f]"), bare).otherwise(col)


def slug(col: Column) -> Column:
    """Accents off, lower case, every other run of characters -> ``_``."""
    joined = F.regexp_replace(F.lower(fold_accents(col)), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.trim(joined, F.lit("_")), F.lit("")),
                      F.when(col.isNotNull(), F.lit(_EMPTY_NAME)))


def normal_code(col: Column, numeric: bool = False) -> Column:
    """One key for ``11``, ``'11 '`` and ``11.0``; null -> ``''``."""
    text = whole_number_text(col) if numeric else strip(col)
    return F.coalesce(text, F.lit(""))


def whole_number_text(col: Column) -> Column:
    """A floating number as text, without ``.0`` when it is whole."""
    whole = (col == F.floor(col)) & (F.abs(col) < 2.0**63)
    return F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))


def null_placeholder(col: Column) -> Column:
    """Texts that mean "no value" become null."""
    return F.when(~col.isin(NULL_TEXTS), col)


def uniform_text(df: DataFrame) -> DataFrame:
    """All columns as text with placeholders nulled: floats lose a bare ``.0`` and
    every column keeps a type even when it is empty."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = whole_number_text(col)
        else:
            text = col.cast("string")
        out.append(null_placeholder(text).alias(field.name))
    return df.select(*out)


def try_integer(col: Column, to: str = "bigint") -> Column:
    """Text to a whole number, rounding decimals half away from zero; invalid -> null."""
    rounded = F.round(col.try_cast("decimal(38,10)")).try_cast(to)
    return F.coalesce(col.try_cast(to), rounded)


def implied_decimals(col: Column, places: int = 8) -> Column:
    """Digits with an implied decimal point; invalid or blank -> null."""
    return strip(col).try_cast("double") / F.lit(float(10**places))

"""Date rules. All of them slice text and cast, so none depends on the session
time zone and invalid text yields null without raising inside a parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleartab.functions.text import full_match, strip

_DAY_MS = 86_400_000
_DIGITS_DATE_TIME = "[0-9]{8}(?:[01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]"
_ISO = r"([0-9]{4})([-/ ])([0-9]{1,2})\2([0-9]{1,2})(?: [0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?)?"


def _digits(col: Column) -> Column:
    """``yyyyMMdd...`` to a date."""
    return F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2),
                       F.substring(col, 7, 2)).try_cast("date")


def date_two_formats(col: Column) -> Column:
    """``yyyyMMdd``, else year-month-day with separators; anything else is null
    (a bare year must not become its first of January)."""
    text = strip(col)
    iso = F.regexp_replace(text, rf"\A{_ISO}\z", "$1-$3-$4").try_cast("date")
    return F.when(full_match(text, "[0-9]{8}"), _digits(text)).when(full_match(text, _ISO), iso)


def date_three_formats(col: Column) -> Column:
    """14 digits, ISO text with ``T``, or 10-13 digits of epoch milliseconds."""
    days = F.floor(col.try_cast("bigint") / F.lit(_DAY_MS)).cast("int")
    return (
        F.when(full_match(col, "[0-9]{14}"),
               F.when(full_match(col, _DIGITS_DATE_TIME), _digits(col)))
        .when(full_match(col, "[0-9]{4}-[0-9]{2}-[0-9]{2}T.*"),
              F.substring(col, 1, 10).try_cast("date"))
        .when(full_match(col, "[0-9]{10,13}"), F.date_add(F.lit("1970-01-01").cast("date"), days))
    )


def within_years(date: Column, first: int, last: int) -> Column:
    """The date when its year lies in the window, else null."""
    return F.when(F.year(date).between(first, last), date)


def year_in_number(col: Column, first: int, last: int) -> Column:
    """Year at characters 10-13 of a 20-digit case number, inside the window."""
    year = F.when(full_match(col, "[0-9]{20}"), F.substring(col, 10, 4).try_cast("int"))
    return F.when(year.between(first, last), year)


def year_with_fallback(date: Column, fallback: Column) -> Column:
    return F.coalesce(F.year(date), fallback)


def year_origin(date: Column, fallback: Column, from_date: str, from_number: str) -> Column:
    """Which of the two gave the year; null when neither did."""
    return F.when(date.isNotNull(), F.lit(from_date)).when(fallback.isNotNull(), F.lit(from_number))


def dates_consistent(earlier: Column, later: Column) -> Column:
    """Three-valued: null as soon as either date is unknown."""
    return earlier <= later


def full_year(digits: Column) -> Column:
    """Two digits to four with the pivot at 90; other lengths stay as they are."""
    two = F.when(digits >= "90", F.concat(F.lit("19"), digits)).otherwise(
        F.concat(F.lit("20"), digits))
    return F.when(F.length(digits) == 2, two).otherwise(digits)


def period_key(name: Column) -> Column:
    """Period of a file name: its digits before the extension, else the name."""
    digits = F.regexp_extract(name, r"([0-9]+)\.\w+$", 1)
    return F.when(digits == "", name).otherwise(full_year(digits))


def timestamp_local(col: Column) -> Column:
    """ISO text to a timestamp without zone (a zone suffix is ignored)."""
    return col.try_cast("timestamp_ntz")


def timestamp_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")

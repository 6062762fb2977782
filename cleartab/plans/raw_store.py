"""Slices of the raw court documents, and the check that all were loaded.

All three steps look at the documents of one subset; ``chosen`` stages the
columns they need, so the raw text is parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleartab.codebooks import courts as book
from cleartab.functions import dates, jsonfields
from cleartab.operators import slices
from cleartab.plans.courts import in_subset
from cleartab.session import Staging


def chosen(raw: DataFrame, subset: str, area: Staging) -> DataFrame:
    rows = in_subset(raw, subset).select("id", "tribunal", "dataAjuizamento", "dataHoraUltimaAtualizacao")
    return area.table(rows, f"chosen-{subset}")


def planned_slices(documents: DataFrame, last_year: int, area: Staging, split: int = slices.MONTH_SPLIT,
                   total: int | None = None) -> DataFrame:
    """Year and month slices by the parsed date. ``total`` is what the source
    declares; with it, years that cannot be trusted to be empty are kept."""
    date = dates.within_years(
        dates.date_three_formats(jsonfields.unquote(F.col("dataAjuizamento"))),
        book.FIRST_YEAR, last_year)
    dated = documents.select(date.alias("d"))
    years = None if total is None else (book.FIRST_YEAR, last_year)
    return slices.slice_plan(dated, F.year("d"), F.month("d"), area, split, total, years)


def residual_documents(documents: DataFrame, covered: list[str],
                       split: int = slices.RESIDUAL_SPLIT) -> DataFrame:
    """Documents outside all covered text ranges, with the slice each goes to."""
    rows = documents.filter(slices.residual(F.col("dataAjuizamento"), covered))
    return slices.residual_slices(
        rows, dates.timestamp_local(F.col("dataHoraUltimaAtualizacao")), split)


def completeness(documents: DataFrame, declared: DataFrame) -> DataFrame:
    """Loaded against declared documents per court; ``declared(tribunal, n)``."""
    return slices.reconcile(documents, declared, "tribunal")

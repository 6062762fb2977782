"""Fixed-width household survey, editions 2013 and 2019."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.codebooks import survey as book
from cleartab.functions import lists, text
from cleartab.functions.codes import decode, flag
from cleartab.operators import columns, ingest, publish
from cleartab.sources import listing
from cleartab.sources.text import read_fixed_width

# Names of the published tables.
KNOWN_TABLE_2013 = "pns_violencia_domestica_2013"
UNKNOWN_TABLE_2013 = "pns_proxy_violencia_desconhecido_2013"
TABLE_2019 = "pns_violencia_domestica_2019"


def decoded(raw: DataFrame, books: Mapping[str, Mapping], blank_age_as_null: bool = False) -> DataFrame:
    """Labels for codes (unknown codes stay), age without zeros, weight as a number."""
    rows = decode(raw, books)
    return rows.select(*[
        text.strip_leading_zeros(F.col(c), blank_age_as_null).alias(c) if c == "idade"
        else text.implied_decimals(F.col(c)).alias(c) if c == "peso_amostral" else F.col(c)
        for c in rows.columns])


def known_aggressor_2013(rows: DataFrame) -> DataFrame:
    out = columns.subset(rows, [*book.COMMON, *book.KNOWN_2013])
    return out.withColumn("parceiro_intimo", flag(F.col("agressor").isin(book.PARTNER_2013)))


def unknown_aggressor_2013(rows: DataFrame) -> DataFrame:
    out = columns.subset(rows, [*book.COMMON, *book.UNKNOWN_2013])
    return columns.strip_prefix(out, book.UNKNOWN_2013, 2)


def outputs_2013() -> dict:
    woman = F.col("sexo") == book.WOMAN_2013
    return {
        KNOWN_TABLE_2013: (woman & (F.col("sofreu_violencia") == "Sim"), known_aggressor_2013),
        UNKNOWN_TABLE_2013: (woman & (F.col("d_sofreu_violencia") == "Sim"),
                             unknown_aggressor_2013),
    }


def table_2019(raw: DataFrame, strict_labels: bool = False,
               blank_age_as_null: bool = False) -> DataFrame:
    """Women with any of the listed acts. The partner flag is decided on answer
    codes; ``strict_labels`` decides on labels, where one cut label never counts."""
    by_code = lists.any_in(book.AGGRESSOR_COLUMNS_2019, book.PARTNER_CODES_2019)
    rows = decoded(raw.withColumn("__partner", by_code), book.BOOKS_2019, blank_age_as_null)
    rows = rows.filter((F.col("sexo") == book.WOMAN_2019) & lists.any_equal(book.ACTS_2019, "Sim"))
    if strict_labels:
        rows = rows.withColumn("__partner", lists.any_in(book.AGGRESSOR_COLUMNS_2019,
                                                         book.PARTNER_LABELS_2019))
    return rows.withColumnRenamed("__partner", "parceiro_intimo")


def _new_files(spark: SparkSession, source: str, manifest_path: str | None) -> DataFrame | None:
    """``(name, size_bytes)`` of the input, or None where the manifest knows it all."""
    if manifest_path is None:
        return listing.list_files(spark, source).select("name", "size_bytes")
    files = listing.list_files(spark, source).select("name", "size_bytes")
    new = ingest.not_in_manifest(files, ingest.read_manifest(spark, manifest_path))
    return None if new.isEmpty() else files


def _done(spark: SparkSession, files: DataFrame, manifest_path: str | None) -> None:
    if manifest_path is not None:
        manifest = ingest.read_manifest(spark, manifest_path)
        publish.write_manifest(ingest.updated_manifest(manifest, files), manifest_path)


def run_2013(spark: SparkSession, source: str, folder: str, manifest_path: str | None = None,
             blank_age_as_null: bool = False) -> dict[str, int]:
    """Rows per table; nothing is read or written, and the result is empty, where the
    manifest knows all input files with their sizes. The manifest is written last."""
    files = _new_files(spark, source, manifest_path)
    if files is None:
        return {}
    raw = read_fixed_width(spark, source, book.SPANS_2013)
    counts = publish.multi_output(decoded(raw, book.BOOKS_2013, blank_age_as_null), outputs_2013(),
                                  lambda df, name: publish.publish(df, f"{folder}/{name}"))
    _done(spark, files, manifest_path)
    return counts


def run_2019(spark: SparkSession, source: str, folder: str, strict_labels: bool = False,
             manifest_path: str | None = None, blank_age_as_null: bool = False) -> int | None:
    """Rows of the table; None where the manifest knows all input files."""
    files = _new_files(spark, source, manifest_path)
    if files is None:
        return None
    raw = read_fixed_width(spark, source, book.SPANS_2019)
    n = publish.publish(table_2019(raw, strict_labels, blank_age_as_null), f"{folder}/{TABLE_2019}")
    _done(spark, files, manifest_path)
    return n

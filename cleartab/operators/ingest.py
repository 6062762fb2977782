"""Choosing which input files to work on: listings and manifests as tables.

``listing(name, size_bytes, ...)`` and ``manifest(source_file, size_bytes)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleartab.functions.dates import full_year, period_key
from cleartab.operators.ordered import in_latest_periods

# Names that are never data.
CONTROL_NAMES = ["_manifest.json"]
CONTROL_PREFIX = "_checkpoint_"

MANIFEST_SCHEMA = "source_file string, size_bytes bigint"


def matches_source(name: Column, prefix: str, extension: str, first_year: int | None = None,
                   last_year: int | None = None) -> Column:
    """Prefix, digits and extension in any case, optionally in a range of years
    (two digits pivot at 90)."""
    upper = F.upper(name)
    digits = F.regexp_extract(upper, rf"\A{prefix.upper()}([0-9]+)\.{extension.upper()}\z", 1)
    fits = digits != ""
    if first_year is None or last_year is None:
        return fits
    return fits & full_year(digits).try_cast("int").between(first_year, last_year)


def is_control(name: Column, extra: Sequence[str] = ()) -> Column:
    return name.isin([*CONTROL_NAMES, *extra]) | name.startswith(CONTROL_PREFIX)


def data_files(listing: DataFrame, ignore: Sequence[str] = (),
               ignore_suffix: str | None = None) -> DataFrame:
    """The listing without control files (and without a suffix, in any case)."""
    keep = ~is_control(F.col("name"), ignore)
    if ignore_suffix:
        keep = keep & ~F.lower("name").endswith(ignore_suffix.lower())
    return listing.filter(keep)


def unique_names(listing: DataFrame) -> DataFrame:
    """One entry per name regardless of case, the first spelling in order. A
    minimum and not a window, so repeats combine before the shuffle."""
    rest = [c for c in listing.columns if c != "name"]
    first = (listing.groupBy(F.upper("name").alias("__key"))
             .agg(F.min(F.struct("name", *rest)).alias("__first")))
    return first.select(*[F.col("__first")[c].alias(c) for c in listing.columns])


def not_in_manifest(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files the manifest lacks or knows with another size."""
    known = manifest.select(F.upper("source_file").alias("__f"), F.col("size_bytes").alias("__s"))
    return listing.join(known, (F.upper("name") == F.col("__f"))
                        & (F.col("size_bytes") == F.col("__s")), "left_anti")


def groups_to_process(parts: DataFrame, manifest: DataFrame, group: str) -> DataFrame:
    """Groups of files (for instance data and dictionary of a year) with at least
    one new or changed part: ``(group, changed)``."""
    known = manifest.select(F.upper("source_file").alias("__f"),
                            F.col("size_bytes").alias("__s"))
    joined = parts.join(known, (F.upper("name") == F.col("__f"))
                        & (F.col("size_bytes") == F.col("__s")), "left")
    return joined.groupBy(group).agg((~F.bool_and(F.col("__f").isNotNull())).alias("changed"))


def to_check(listing: DataFrame, manifest: DataFrame, periods: int = 2) -> DataFrame:
    """Files of the latest periods, and older ones the manifest does not know."""
    keyed = listing.withColumn("period", period_key(F.col("name")))
    recent = in_latest_periods(keyed, "period", periods)
    known = manifest.select(F.upper("source_file").alias("__f"))
    new = keyed.join(known, F.upper("name") == F.col("__f"), "left_anti")
    return recent.unionByName(new).distinct()


def pair_by_year(data: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Match two listings by the last four-digit year of the file stem. One-sided
    years are kept with their status; several files of a year: the last counts."""
    def by_year(listing, column):
        stem = F.regexp_replace("name", r"\.[^.]*$", "")
        years = F.regexp_extract_all(stem, F.lit(r"([0-9]{4})"), F.lit(1))
        year = F.when(F.size(years) > 0, F.element_at(years, -1))
        return (listing.select(year.alias("year"), "name").filter(F.col("year").isNotNull())
                .groupBy("year").agg(F.max("name").alias(column)))

    both = by_year(data, "data_file").join(by_year(dictionaries, "dict_file"), "year",
                                           "full_outer")
    return both.withColumn(
        "status", F.when(F.col("dict_file").isNull(), F.lit("data_only"))
        .when(F.col("data_file").isNull(), F.lit("dictionary_only")).otherwise(F.lit("paired")))


def listing_diff(source: DataFrame, copy: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """What a copy needs to equal its source: new, changed, unchanged or orphan."""
    left = source.select("name", F.col("size_bytes").alias("size_source"))
    right = (copy.filter(~F.col("name").isin(list(ignore))) if ignore else copy).select(
        "name", F.col("size_bytes").alias("size_copy"))
    status = (F.when(F.col("size_copy").isNull(), F.lit("new"))
              .when(F.col("size_source").isNull(), F.lit("orphan"))
              .when(F.col("size_source") == F.col("size_copy"), F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return left.join(right, "name", "full_outer").withColumn("status", status)


def read_manifest(spark, path: str) -> DataFrame:
    """The newest manifest, names in upper case; an absent one is empty. One written
    as a plain table, or left in the middle of a swap, by an earlier version is
    read as well."""
    from cleartab.operators import snapshots
    from cleartab.operators.publish import recover
    from cleartab.sources.listing import exists

    recover(spark, path)
    at, _ = snapshots.state(spark, path)
    if at >= 0:
        rows = snapshots.read(spark, path, at)
    elif exists(spark, path):
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    else:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return rows.select(F.upper("source_file").alias("source_file"), F.col("size_bytes").cast("bigint").alias("size_bytes"))


def updated_manifest(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Old entries without the files just done, plus these. ``done(name, size_bytes)``."""
    new = done.select(F.upper("name").alias("source_file"), "size_bytes")
    kept = manifest.join(new.select("source_file"), "source_file", "left_anti")
    return kept.unionByName(new)

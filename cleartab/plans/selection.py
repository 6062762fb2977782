"""Which remote files to fetch: by rule, by recency and by manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleartab.operators import ingest


def files_to_fetch(listing: DataFrame, manifest: DataFrame, prefix: str, extension: str,
                   first_year: int | None = None, last_year: int | None = None,
                   periods: int = 2) -> DataFrame:
    """Files of the source in the year range, one spelling each; of these the latest
    periods and the unknown ones are checked, and fetched when new or changed."""
    mine = listing.filter(ingest.matches_source(F.col("name"), prefix, extension,
                                                first_year, last_year))
    checked = ingest.to_check(ingest.unique_names(mine), manifest, periods)
    return ingest.not_in_manifest(checked, manifest)

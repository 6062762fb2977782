"""The common shape of the two record jobs: check inputs, decode, replace by file."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.functions.text import uniform_text
from cleartab.operators import ingest, publish
from cleartab.session import Staging
from cleartab.sources import listing
from cleartab.sources.dbf import dbf_status, read_dbf
from cleartab.sources.text import read_parquet_union

class NoReadableInput(ValueError):
    """None of the chosen files can be read."""


STATUS = "name string, size_bytes bigint, status string, n_records bigint, error string"


def choose_files(files: DataFrame, manifest: DataFrame, prefix: str,
                 extension: str = "dbf") -> DataFrame:
    """Files of the source, one spelling per name, new or changed since the
    manifest was written."""
    mine = files.filter(ingest.matches_source(F.col("name"), prefix, extension))
    return ingest.not_in_manifest(ingest.unique_names(mine), manifest)


def from_dbf(spark: SparkSession, chosen: DataFrame, columns: Sequence[str] | None = None,
             area: Staging | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, status)``: rows of the readable files only; the status names the
    others, which are neither replaced nor marked as done. The status is staged,
    so every file is checked once; the driver gets the paths to read."""
    status = (area or Staging(spark)).table(dbf_status(chosen), f"status-{uuid.uuid4().hex}")
    good = [(r.path, r.size_bytes) for r in status.filter("status = 'ok'").select("path", "size_bytes").collect()]
    if not good:
        raise NoReadableInput("no readable input file")
    return read_dbf(spark, good, columns), status


def from_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Already converted records; lineage is the column if present, else the file."""
    rows = read_parquet_union(spark, paths)
    lineage = F.col(LINEAGE) if LINEAGE in rows.columns else F.col("_metadata.file_name")
    rows = rows.withColumn("__f", lineage)
    return uniform_text(rows.drop(LINEAGE).withColumnRenamed("__f", LINEAGE))


PLACEHOLDER = "__ORIGEM__"


def sql_hook(text: str, **values) -> Callable[[DataFrame], DataFrame]:
    """A row filter or projection as SQL text, for ``select`` and ``project`` of a job.

    ``__ORIGEM__`` stands for the rows the hook is applied to, which are handed to
    ``spark.sql`` as an argument; ``:name`` markers take the given values.
    """
    if PLACEHOLDER not in text:
        raise ValueError(f"the text of a hook reads from {PLACEHOLDER}")
    query = text.replace("{", "{{").replace("}", "}}").replace(PLACEHOLDER, "{origem}")

    def hook(rows: DataFrame) -> DataFrame:
        return rows.sparkSession.sql(query, args=values or None, origem=rows)

    return hook


def run(rows: DataFrame, status: DataFrame, select: Callable | str, project: Callable | str,
        target: str, manifest_path: str, replace: Callable = publish.publish_replacing) -> int:
    """Publish the batch, then mark its files as done. The names of the new files,
    one for each, pass through the driver.

    ``select`` and ``project`` are functions or SQL texts (see ``sql_hook``);
    ``replace`` is the sink, ``snapshots.replace_sources`` where readers go on
    during the change.
    """
    spark = rows.sparkSession
    select, project = (sql_hook(h) if isinstance(h, str) else h for h in (select, project))
    done = status.filter("status = 'ok'").select("name", "size_bytes")
    files = [r[0] for r in done.select("name").collect()]
    written = replace(rows.transform(select).transform(project), target, files)
    manifest = ingest.read_manifest(spark, manifest_path)
    publish.write_manifest(ingest.updated_manifest(manifest, done), manifest_path)
    return written


def job(spark: SparkSession, source: str, pattern: tuple[str, str], columns: Sequence[str], select: Callable,
        project: Callable, target: str, manifest_path: str) -> DataFrame:
    """List, check, read, select, project, replace by file, and mark as done.

    Returns ``(name, size_bytes, status, n_records, error)`` of the new or changed
    files. A file that cannot be read is reported, keeps its published rows and
    is tried again next time. Without new files nothing is touched.
    """
    manifest = ingest.read_manifest(spark, manifest_path)
    chosen = choose_files(listing.list_files(spark, source), manifest, *pattern)
    with Staging(spark) as area:
        chosen = area.table(chosen, "chosen")
        if chosen.isEmpty():
            return spark.createDataFrame([], STATUS)
        try:
            rows, status = from_dbf(spark, chosen, columns, area)
            run(rows, status, select, project, target, manifest_path)
        except NoReadableInput:
            status = dbf_status(chosen)
        names = [c.split()[0] for c in STATUS.split(", ")]
        return spark.createDataFrame(status.select(*names).collect(), STATUS)  # one row per new file

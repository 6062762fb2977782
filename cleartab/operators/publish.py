"""Sinks: Parquet tables, replace-by-source publishing, manifests, catalog."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.operators import snapshots
from cleartab.operators.ordered import numbered
from cleartab.session import Staging
from cleartab.sources import listing


def publish(df: DataFrame, path: str, rows_per_file: int = 0) -> int:
    """Write a table and return its rows, counted by the tasks that write them: one
    job, and nothing is read again. An empty table is written with its schema. The
    number of files follows the partitions of the plan, which adaptive execution
    sizes; ``rows_per_file`` caps a file."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return seen.get["n_rows"]


def append_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def publish_swapped(df: DataFrame, path: str) -> int:
    """Overwrite a table the plan itself reads: write beside it, then rename. A
    swap that was interrupted before is undone first."""
    spark = df.sparkSession
    recover(spark, path)
    staged, old = f"{path}__new-{uuid.uuid4().hex}", f"{path}__old"
    rows = publish(df, staged)
    if listing.exists(spark, path):
        if listing.exists(spark, old):
            listing.delete(spark, old)
        listing.move(spark, path, old)
    listing.move(spark, staged, path)
    listing.delete(spark, old)
    return rows


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the previous table if a swap stopped between its two renames."""
    if not listing.exists(spark, path) and listing.exists(spark, f"{path}__old"):
        listing.move(spark, f"{path}__old", path)


def replace_by_source(published: DataFrame, batch: DataFrame, files: Iterable[str]) -> DataFrame:
    """Published rows without those of the given source files, plus the batch,
    united by name. File names are compared without case; a file of the batch
    that yields no rows still loses its old ones."""
    names = sorted({f.upper() for f in files})
    gone = published.sparkSession.createDataFrame([(n,) for n in names], "__f string")
    kept = published.join(gone, F.upper(LINEAGE) == F.col("__f"), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def publish_replacing(batch: DataFrame, path: str, files: Iterable[str]) -> int:
    """Replace the rows of some source files in a published table; returns the
    rows written.

    The table is partitioned by source file, so only the partitions of the batch
    are written; nothing already published is read or rewritten, however large.
    The batch is staged once and checked; its partitions then replace the old
    ones in the commit of one write, and only after that do the partitions go
    whose files have no rows any more or another spelling. Rows are rebalanced by
    file: small files do not multiply, a large one is split.
    """
    spark = batch.sparkSession
    wanted = {f.upper() for f in files}
    with Staging(spark) as area:
        rows = area.table(batch, "batch")
        held = {r[0]: r[1] for r in rows.groupBy(LINEAGE).agg(F.count("*")).collect()}  # one row per file of the batch
        stray = sorted(s for s in held if (s or "").upper() not in wanted)
        if stray:
            raise ValueError(f"rows of files outside the batch: {stray[:5]}")
        listing.make_folder(spark, path)
        if held:
            (rows.hint("rebalance", LINEAGE).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(LINEAGE).parquet(path))
    for source, folder in children_by_source(spark, path).items():
        if source.upper() in wanted and source not in held:
            listing.delete(spark, f"{path}/{folder}")
    return sum(held.values())


def children_by_source(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folder of each source file of a published table."""
    prefix = f"{LINEAGE}="
    return {unquote(c.removeprefix(prefix)): c for c in listing.children(spark, path)
            if c.startswith(prefix)}


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by source file, united by name, lineage as text."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.withColumn(LINEAGE, F.col(LINEAGE).cast("string"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The last step of a job: only published files may be marked as done. The
    manifest is a table of snapshots, so a reader finds the old or the new one, and
    of two jobs that started from the same manifest the later one fails."""
    snapshots.overwrite(manifest, path)


def multi_output(decoded: DataFrame, outputs: Mapping[str, tuple[Column, Callable]],
                 sink: Callable[[DataFrame, str], int]) -> dict[str, int]:
    """Several tables from one scan: ``outputs`` maps a name to a row condition and
    a projection. Rows that no output wants are dropped before the rest is staged
    for the writes, so what is held is the size of the outputs."""
    wanted = F.lit(False)
    for condition, _ in outputs.values():
        wanted = wanted | F.coalesce(condition, F.lit(False))
    with Staging(decoded.sparkSession) as area:
        kept = area.table(decoded.filter(wanted), "kept")
        return {name: sink(project(kept.filter(condition)), name)
                for name, (condition, project) in outputs.items()}


def isolated(spark: SparkSession, units: Iterable[str], work: Callable[[str], int], parallel: int = 8,
             seconds: float | None = None, wanted: Callable[[str], bool] = lambda unit: True) -> DataFrame:
    """Run the Spark jobs of several units, recording a failure and going on:
    ``(unit, status, n_rows, error)`` in the order given.

    Up to ``parallel`` units run at once, each in a job group and a fair-scheduler
    pool of its own (``session.build`` sets fair scheduling), so a slow one does
    not hold up the others. A unit that takes longer than ``seconds``, or that
    ``wanted`` gives up, has its jobs cancelled and is recorded as such.
    """
    units, context, run = list(units), spark.sparkContext, uuid.uuid4().hex
    begun: dict[str, float] = {}
    cancelled: dict[str, str] = {}

    def one(unit: str) -> tuple:
        context.setLocalProperty("spark.scheduler.pool", f"{run}-{unit}")
        context.setJobGroup(f"{run}-{unit}", unit, interruptOnCancel=True)
        begun[unit] = time.monotonic()
        try:
            if not wanted(unit):
                return unit, "cancelled", None, "not wanted any more"
            return unit, "processed", work(unit), None
        except Exception as error:  # recorded, and the other units still run
            if unit in cancelled:
                return unit, "cancelled", None, cancelled[unit]
            return unit, "failed", None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max(1, min(parallel, len(units)))) as pool:
        running = {pool.submit(inheritable_thread_target(spark)(one), unit): unit for unit in units}
        waiting = set(running)
        while waiting:
            _, waiting = wait(waiting, timeout=0.2, return_when=FIRST_COMPLETED)
            for unit in [running[f] for f in waiting if running[f] in begun]:
                if seconds is not None and time.monotonic() - begun[unit] > seconds:
                    cancelled.setdefault(unit, f"took more than {seconds:g} seconds")
                elif not wanted(unit):
                    cancelled.setdefault(unit, "not wanted any more")
                if unit in cancelled:  # again for jobs that began since
                    context.cancelJobGroup(f"{run}-{unit}")
        rows = [f.result() for f in running]
    return spark.createDataFrame(rows, "unit string, status string, n_rows bigint, error string")


def run_summary(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n_units"),
                                        F.sum("n_rows").alias("n_rows"))


# Columns of the published catalog, and the text for an unmapped folder.
CATALOG_COLUMNS = ["arquivo", "diretorio", "fontes_relacionadas", "num_registros", "num_colunas",
                   "tamanho_bytes", "ultima_atualizacao"]
UNMAPPED = "(não mapeado)"


def write_catalog(catalog: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """CSV lines in file order, over as many part files as it takes: read in the
    order of their names, they are one CSV with a byte-order mark and one header.

    Every line knows its number in the whole, from the counts of the sorted
    partitions before it, so only the line with number 0 is the header.
    """
    first = CATALOG_COLUMNS[0]
    with Staging(catalog.sparkSession) as area:
        rows = numbered(catalog.select(*CATALOG_COLUMNS), [F.col(first)], "__n", area)
        lines = rows.select("__n", F.to_csv(F.struct(*CATALOG_COLUMNS)).alias("value"))
        head = catalog.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("__n"),
                                                    F.lit("\ufeff" + ",".join(CATALOG_COLUMNS)).alias("value"))
        (lines.unionAll(head).orderBy("__n").select("value").write.mode("overwrite")
         .option("maxRecordsPerFile", rows_per_file).text(path))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The published catalog, all columns as text."""
    lines = spark.read.text(path).filter(~F.ltrim("value", F.lit("\ufeff")).startswith(f"{CATALOG_COLUMNS[0]},"))
    schema = ", ".join(f"{c} string" for c in CATALOG_COLUMNS)
    return lines.select(F.from_csv("value", schema).alias("r")).select("r.*")


def names_by_folder(sources: DataFrame) -> DataFrame:
    """Source names per folder in catalog order, joined by ``' | '``. The source
    catalog is a hand-kept list of a few entries."""
    return (sources.groupBy("folder")
            .agg(F.sort_array(F.collect_list(F.struct("position", "name"))).alias("l"))
            .select("folder", F.array_join(F.transform("l", lambda s: s["name"]), " | ")
                    .alias("names")))

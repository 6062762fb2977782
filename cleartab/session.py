"""Session settings the library is designed for."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "cleartab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI, adaptive execution and skew-join handling.

    Executor sizes, the number of shuffle partitions and the checkpoint
    directory belong to the cluster and are left to it; adaptive execution
    coalesces or splits the shuffle partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Units that run side by side share the executors instead of queueing.
        "spark.scheduler.mode": "FAIR",
        # Projections of some hundred expressions compile to methods the JVM will
        # not optimise; past this size the interpreted projection is faster.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (local tests) is a temporary folder made
    and recorded in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="cleartab-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging root; never reused between runs."""
    return f"{staging_root(spark)}/cleartab/{uuid.uuid4().hex}/{name}"


_areas: ContextVar[list | None] = ContextVar("areas", default=None)


@contextmanager
def swept() -> Iterator[None]:
    """Deletes, at its end, all staged tables of the areas made inside: for the
    step of a job whose result has been written by then."""
    token = _areas.set([])
    try:
        yield
    finally:
        areas = _areas.get()
        _areas.reset(token)
        for area in areas:
            area.close()


class Staging:
    """Tables written once in the shared folder and read back.

    This cuts the lineage with files that outlive any executor, and keeps column
    pruning for each later reader. As a context manager it removes its tables at
    the end of the job.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = staging_path(spark, "tables")
        if (made := _areas.get()) is not None:
            made.append(self)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing will read any more."""
        self._delete(f"{self.root}/{name}")

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def close(self) -> None:
        """Delete all tables."""
        self._delete(self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def local_path(path: str) -> str | None:
    """The local path of a ``file:`` or scheme-less path, else None."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else os.path.abspath(path)

"""Raw documents arriving as line-JSON files, kept as levelled runs.

Each micro-batch is reduced to the latest version of its own documents and becomes
a run of level 0. As soon as FANOUT runs stand on a level, they are merged into one
run of the next level that holds the latest versions only. A document is thus
rewritten once per level, and a reader sees at most FANOUT - 1 runs per level,
however many batches there were. The log of the store (see ``snapshots``) says
which runs are live and which batches are in. Lines that are no JSON are kept
beside the documents, as text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.operators import snapshots
from cleartab.operators.versions import latest_version
from cleartab.sources import listing

RUN = "_run"
BATCH = "_batch"
BAD_LINE = "_bad_line"
FANOUT = 8
"""Runs of one level that are merged into one of the next."""


def _text(fields: Sequence[str]) -> str:
    return ", ".join(f"`{f}` string" for f in fields)


def _add(spark: SparkSession, path: str, run: str, number: int, batch: DataFrame) -> None:
    """Make a batch a live run of level 0, once: a batch repeated after a failure is known by its number."""
    done = lambda now: now.get("batches", {}).get(run, -1) >= number
    if done(snapshots.state(spark, path)[1]):
        return
    folder, n = snapshots.write_folder(batch, path)

    def edit(now: dict) -> dict | None:
        if done(now):
            return None
        parts = [*now["parts"], {"folder": folder, "level": 0, "rows": n}] if n else now["parts"]
        return {"parts": parts, "schema": snapshots.united(now["schema"], batch.schema).json(),
                "batches": now.get("batches", {}) | {run: number}}

    snapshots.change(spark, path, edit)


def compact(spark: SparkSession, store: str, keys: Sequence[str], order: Sequence[Column], fanout: int = FANOUT,
            whole: bool = False) -> int:
    """Merge full levels, lowest first, until none is full; ``whole`` merges all runs into one.

    Returns the merges made. A merge counts in one log entry that takes its inputs
    out and its output in; readers of the version before still find their files.
    Batches that come in meanwhile stay live: the entry is put on top of them.
    """
    path, merges = f"{store}/documents", 0
    while True:
        _, now = snapshots.state(spark, path)
        levels: dict[int, list[dict]] = {}
        for p in now["parts"]:
            levels.setdefault(p["level"], []).append(p)
        full = [level for level, runs in sorted(levels.items()) if len(runs) >= fanout]
        if whole and len(now["parts"]) > 1:
            chosen, level = now["parts"], max(levels)
        elif full:
            chosen, level = levels[full[0]], full[0] + 1
        else:
            return merges
        names = {p["folder"] for p in chosen}
        rows = snapshots.read(spark, path, where=lambda p: p["folder"] in names)
        folder, n = snapshots.write_folder(latest_version(rows, keys, order, scanned=True), path)

        def edit(state: dict) -> dict | None:
            rest = [p for p in state["parts"] if p["folder"] not in names]
            if len(rest) + len(names) != len(state["parts"]):  # another merge took some of them
                return None
            return state | {"parts": [*rest, {"folder": folder, "level": level, "rows": n}]}

        snapshots.change(spark, path, edit)
        merges += 1


def ingest(spark: SparkSession, source: str, store: str, checkpoint: str, fields: Sequence[str],
           keys: Sequence[str], order: Sequence[Column], fanout: int = FANOUT, files_per_batch: int | None = None) -> None:
    """Take in all files not seen before, merge full levels, and stop.

    A batch is known by its checkpoint and number: repeated after a failure it is
    taken in once, and a new checkpoint, whose numbers start again, hides nothing
    of an older one.
    """
    run = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        good = batch.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
        _add(spark, f"{store}/documents", run, number, latest_version(good, keys, order, scanned=True))
        (batch.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE).write.mode("overwrite")
         .parquet(f"{store}/bad_lines/{RUN}={run}/{BATCH}={number}"))
        compact(spark, store, keys, order, fanout)

    reader = (spark.readStream.schema(f"{_text(fields)}, `{BAD_LINE}` string").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD_LINE))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.json(source).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current(spark: SparkSession, store: str, fields: Sequence[str], keys: Sequence[str],
            order: Sequence[Column]) -> DataFrame:
    """The latest version of every document in the store, from its live runs; a single run is read as it is."""
    path = f"{store}/documents"
    at, now = snapshots.state(spark, path)
    if at < 0:
        return spark.createDataFrame([], _text(fields))
    rows = snapshots.read(spark, path, at).select(*[F.col(f"`{f}`") for f in fields])
    return rows if len(now["parts"]) < 2 else latest_version(rows, keys, order)


def live_rows(spark: SparkSession, store: str) -> dict[int, list[int]]:
    """Rows of each live run, by level."""
    levels: dict[int, list[int]] = {}
    for p in snapshots.state(spark, f"{store}/documents")[1]["parts"]:
        levels.setdefault(p["level"], []).append(p["rows"])
    return levels


def bad_lines(spark: SparkSession, store: str) -> DataFrame:
    """Lines that were no JSON, with the run and batch that met them."""
    path, schema = f"{store}/bad_lines", f"{BAD_LINE} string, {RUN} string, {BATCH} bigint"
    return spark.read.schema(schema).parquet(path) if listing.exists(spark, path) else spark.createDataFrame([], schema)

"""Writing DBF files from a DataFrame, so that the DBF scan has input."""

from __future__ import annotations

import os
import struct
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.session import local_path
from cleartab.sources.listing import delete

Fields = list[tuple[str, str, int]]
HELD = 16 << 20
"""Bytes of records that a writing task holds before they go out."""


def header(n: int, fields: Fields) -> bytes:
    """File header and field descriptors."""
    length = 1 + sum(size for _, _, size in fields)
    out = [struct.pack("<BBBBIHH20x", 3, 24, 1, 1, n, 32 + 32 * len(fields) + 1, length)]
    for name, kind, size in fields:
        out.append(struct.pack("<11sc4xBB14x", name.encode("latin-1"), kind.encode(), size, 0))
    return b"".join(out) + b"\r"


def records(rows: list[list[str]], fields: Fields, deleted: set[int] = frozenset()) -> bytes:
    """Fixed-length records."""
    out = []
    for at, row in enumerate(rows):
        out.append(b"*" if at in deleted else b" ")
        out += [v.encode("latin-1")[:size].ljust(size) for v, (_, _, size) in zip(row, fields)]
    return b"".join(out)


def dbf_bytes(rows: list[list[str]], fields: Fields, deleted: set[int] = frozenset()) -> bytes:
    """A whole small file."""
    return header(len(rows), fields) + records(rows, fields, deleted) + b"\x1a"


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, through the session's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()


def write_dbf(df: DataFrame, folder: str, fields: Fields, file: Column) -> list[tuple[str, str, int]]:
    """One file per value of ``file``; returns ``(path, name, size)`` of each.

    No file is written by one task alone. Every task writes the records of its rows,
    in runs of one file name, into a draft of its own. Counts place the runs in their
    files, and tasks copy them there. Rows are neither shuffled nor sorted; a task
    holds ``HELD`` bytes of records. The driver gets one line per run. The folder must
    be one that all tasks share and can open.
    """
    target = local_path(folder)
    if target is None:
        raise ValueError("test files are written to a mounted folder")
    drafts, length = f"{target}/.drafts-{uuid.uuid4().hex}", 1 + sum(size for _, _, size in fields)
    os.makedirs(drafts)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, done, held = f"{drafts}/{uuid.uuid4().hex}", [], defaultdict(bytearray)

        def flush():
            with open(path, "ab") as out:
                for key, data in held.items():
                    done.append((path, key, out.tell(), len(data) // length))
                    out.write(data)
            held.clear()

        for batch in batches:
            for key, rows in batch.groupby("__file", sort=False):
                texts = [["" if v is None else str(v) for v in r] for r in rows.drop(columns="__file").itertuples(index=False)]
                held[key] += records(texts, fields)
            if sum(map(len, held.values())) >= HELD:
                flush()
        if held:
            flush()
        yield pd.DataFrame(done, columns=["draft", "name", "start", "n"])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for run in batch.itertuples(index=False):
                with open(run.draft, "rb") as source, open(f"{target}/{run.name}", "r+b") as out:
                    source.seek(run.start)
                    out.seek(run.at)
                    left = run.n * length
                    while left:
                        data = source.read(min(left, 1 << 20))
                        if not data:
                            raise EOFError(f"{run.draft} ends inside a run")
                        out.write(data)
                        left -= len(data)
            yield batch[["n"]]

    spark = df.sparkSession
    rows = df.select(*[f[0] for f in fields], file.alias("__file"))
    runs = rows.mapInPandas(write, "draft string, name string, start bigint, n bigint").collect()
    counts, placed, first = Counter(), [], 32 + 32 * len(fields) + 1
    for run in runs:
        placed.append((*run, first + counts[run.name] * length))
        counts[run.name] += run.n
    files = []
    for name, n in counts.items():
        with open(f"{target}/{name}", "wb") as out:
            out.write(header(n, fields))
            out.seek(first + n * length)
            out.write(b"\x1a")
            files.append((f"{target}/{name}", name, out.tell()))
    if placed:
        tasks = min(len(placed), 4 * spark.sparkContext.defaultParallelism)
        spark.createDataFrame(placed, "draft string, name string, start bigint, n bigint, at bigint").repartition(tasks).mapInPandas(
            place, "n bigint").agg(F.sum("n")).collect()
    delete(spark, f"file://{drafts}")
    return files

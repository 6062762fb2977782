"""Tables as versioned snapshots: data folders that never change, and a log that says which of them count.

A writer puts its rows into a folder of their own and then adds the next log entry.
Entries are put only where none is yet, so of two writers that started from the
same version one fails; a writer that stops at any step leaves the table as it
was. Readers take the newest entry and read the folders it names, with the schema
it holds: never both states, never none, and no file is looked into beforehand.

An entry lists all live folders (one per source file, or one per run), so it
grows with their number and not with the rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleartab import LINEAGE
from cleartab.session import local_path
from cleartab.sources import listing

LOG = "_log"
WRITE = "_write"
"""Partition column of the folders of one write; not part of the table."""


class Conflict(Exception):
    """Another writer has put the next version first."""


def _entry(path: str, version: int) -> str:
    return f"{path}/{LOG}/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose entry is there, oldest first."""
    return sorted(int(n[:12]) for n in listing.children(spark, f"{path}/{LOG}") if n.endswith(".json") and n[:12].isdigit())


def state(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict]:
    """The newest version (or the given one) and what it holds; version -1 is the table before its first write."""
    at = version if version is not None else max(versions(spark, path), default=-1)
    if at < 0:
        return -1, {"parts": [], "schema": None}
    return at, json.loads(spark.read.text(_entry(path, at), wholetext=True).first()[0])


def commit(spark: SparkSession, path: str, version: int, content: dict) -> int:
    """Put the entry of a version; raises Conflict if there is one. The entry is written whole beside its
    place and then moved there, which fails where the name is taken."""
    text, place = json.dumps(content).encode(), _entry(path, version)
    try:
        if (local := local_path(place)) is not None:
            _link(local, text)
        else:
            _rename(spark, place, text)
    except FileExistsError as error:
        raise Conflict(f"version {version} of {path} is taken") from error
    return version


def _link(place: str, text: bytes) -> None:
    """On a mounted folder: a second name for the draft, which the file system gives once only."""
    folder = os.path.dirname(place)
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    try:
        with open(draft, "xb") as out:
            out.write(text)
        os.link(draft, place)
    finally:
        os.unlink(draft)


def _rename(spark: SparkSession, place: str, text: bytes) -> None:
    """Elsewhere: the file system's rename without overwriting."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(place)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(draft, False)
    out.write(bytearray(text))
    out.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(target), none)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise FileExistsError(place) from error
        raise


def change(spark: SparkSession, path: str, edit: Callable[[dict], dict | None], tries: int = 20) -> int:
    """Apply an edit to the newest state, again from the start when another writer was first.

    Only for edits that hold whatever the others did, such as adding a folder. An
    edit that gives None changes nothing.
    """
    for _ in range(tries):
        at, now = state(spark, path)
        content = edit(now)
        if content is None:
            return at
        try:
            return commit(spark, path, at + 1, content)
        except Conflict:
            continue
    raise Conflict(f"{path}: {tries} other writers were first")


def united(schema: str | None, other: T.StructType) -> T.StructType:
    """Columns of both, by name; a column that changes its type is an error."""
    fields = {f.name: f for f in (T.StructType.fromJson(json.loads(schema)).fields if schema else [])}
    for f in other.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {fields[f.name].dataType.simpleString()}, is {f.dataType.simpleString()}")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def write_folder(df: DataFrame, path: str, partition: Sequence[str] = ()) -> tuple[str, int]:
    """A new data folder that no version names yet, and its rows, counted while they are written."""
    folder = f"{WRITE}={uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = counted.write.partitionBy(*partition) if partition else counted.write
    writer.parquet(f"{path}/{folder}")
    return folder, seen.get["n"]


def read(spark: SparkSession, path: str, version: int | None = None, where: Callable[[dict], bool] | None = None) -> DataFrame:
    """The table of the newest (or a given) version; ``where`` picks some of its folders.

    A table that was never written has no schema and cannot be read.
    """
    at, now = state(spark, path, version)
    if at < 0:
        raise FileNotFoundError(f"no version of {path}")
    schema = T.StructType.fromJson(json.loads(now["schema"]))
    folders = [f"{path}/{p['folder']}" for p in now["parts"] if where is None or where(p)]
    if not folders:
        return spark.createDataFrame([], schema)
    hidden = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())])
    return spark.read.schema(hidden).option("basePath", path).parquet(*folders).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def overwrite(df: DataFrame, path: str) -> int:
    """The table becomes these rows (the plan may read the table itself); returns their number."""
    spark = df.sparkSession
    at, _ = state(spark, path)
    folder, n = write_folder(df, path)
    commit(spark, path, at + 1, {"parts": [{"folder": folder}], "schema": united(None, df.schema).json()})
    return n


def replace_sources(batch: DataFrame, path: str, files: Iterable[str]) -> int:
    """Replace the rows of some source files; returns the rows written.

    Only the batch is written. Old and new rows, and old and new spellings of a
    file, change places in one log entry; a file of the batch without rows loses
    its old ones. Names are compared without case. Rows of other files, or of
    none, are an error, and nothing changes.
    """
    spark = batch.sparkSession
    wanted = {f.upper() for f in files}
    at, now = state(spark, path)
    folder, n = write_folder(batch.hint("rebalance", LINEAGE), path, [LINEAGE])
    from cleartab.operators.publish import children_by_source
    held = children_by_source(spark, f"{path}/{folder}")
    stray = sorted(s for s in held if s.upper() not in wanted)
    if stray:
        listing.delete(spark, f"{path}/{folder}")
        raise ValueError(f"rows of files outside the batch: {stray[:5]}")
    kept = [p for p in now["parts"] if p["source"].upper() not in wanted]
    new = [{"folder": f"{folder}/{child}", "source": source} for source, child in sorted(held.items())]
    commit(spark, path, at + 1, {"parts": kept + new, "schema": united(now["schema"], batch.schema).json()})
    return n


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_ms: int = 86_400_000) -> int:
    """Delete folders that none of the newest ``keep`` versions names, and the entries before those.

    Folders younger than ``older_than_ms`` stay, as a writer may be about to name
    them. Returns the number of folders deleted.
    """
    last = versions(spark, path)[-keep:]
    live = {p["folder"].split("/")[0] for v in last for p in state(spark, path, v)[1]["parts"]}
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    now = spark._jvm.java.lang.System.currentTimeMillis()
    gone = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName().startswith(f"{WRITE}=")
            and s.getPath().getName() not in live and now - s.getModificationTime() >= older_than_ms]
    for v in versions(spark, path):
        if v not in last:
            listing.delete(spark, _entry(path, v))
    for folder in gone:
        fs.delete(folder, True)
    return len(gone)

"""Files as tables: listings, Parquet footers, and small file-system helpers."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from cleartab.session import local_path


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return fs.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    a, fs = _hadoop(spark, source)
    b, _ = _hadoop(spark, target)
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop(spark, path)
    fs.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    target, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def plain(spark: SparkSession, uri: str) -> str:
    """The path of an encoded URI, as readers take it."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """First line of a text file, unpacked if its name says that it is packed; no more than a buffer is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, fs = _hadoop(spark, path)
    stream = fs.open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        reader = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding)
        return jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()


class UnreachableStorage(Exception):
    """No file system for a scheme. This is the set-up's fault and stops the job; a file that cannot be read does not."""


# Schemes of the cluster's file systems under the names that a task's own reader knows.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfss", "abfs": "abfs", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs"}


def open_binary(path: str):
    """Open a file inside a task: local paths directly, others through Arrow's
    file systems, with the credentials of the executor's environment."""
    local = local_path(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    scheme, _, rest = path.partition("://")
    try:
        system, inner = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    except Exception as error:
        raise UnreachableStorage(f"tasks cannot open {scheme}:// ({error}); copy the files to a store they can") from error
    return system.open_input_file(inner)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``(path, key, name, folder, size_bytes, modified)`` of all files below a
    folder. The content column is never requested, so no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    base = root.rstrip("/").split("://")[-1].removeprefix("file:").rstrip("/")
    key = F.substring_index("path", base + "/", -1)
    return reader.load(root).select(
        "path", key.alias("key"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.when(F.instr(key, "/") > 0, F.element_at(F.split(key, "/"), 1)).otherwise("").alias("folder"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"))


def leaf_columns(kind: DataType) -> int:
    """Columns that a file stores for a type: one for each scalar inside it."""
    if isinstance(kind, StructType):
        return sum(leaf_columns(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return leaf_columns(kind.elementType)
    if isinstance(kind, MapType):
        return leaf_columns(kind.keyType) + leaf_columns(kind.valueType)
    return 1


def parquet_footers(files: DataFrame, at_once: int = 16) -> DataFrame:
    """``(path, n_rows, n_columns, error)``: rows and leaf columns of each Parquet
    file; nulls and the error where it cannot be read.

    Spark reads the schema of each file from its footer, ``at_once`` files side by
    side, and then counts all rows in one job that reads no column. The paths pass
    through the driver, as a catalog has one line per file.
    """
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").collect()]

    def shape(path: str) -> tuple:
        try:
            uri = _hadoop(spark, path)[0].toUri().toString()
        except Exception as error:
            raise UnreachableStorage(f"tasks cannot open {path.partition(':')[0]}:// ({error})") from error
        try:
            return path, uri, leaf_columns(spark.read.parquet(path).schema), None
        except Exception as error:  # an unreadable file is a result, not a failure
            return path, uri, None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(at_once) as pool:
        shapes = list(pool.map(shape, paths))
    found = spark.createDataFrame(shapes, "path string, __uri string, n_columns bigint, error string")
    good = [path for path, _, n, _ in shapes if n is not None]
    if not good:
        return found.select("path", F.lit(None).cast("bigint").alias("n_rows"), "n_columns", "error")
    file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("__file")
    counts = spark.read.parquet(*good).groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    own = F.regexp_replace("__uri", "^file:/+", "file:/")
    rows = F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0)))
    return found.join(counts, own == F.col("__file"), "left").select("path", rows.cast("bigint").alias("n_rows"), "n_columns", "error")


def table_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Rows of each named Parquet table, counted without reading a column."""
    counts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(name).alias("table_name"), "n_rows") for name, path in tables.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionAll(other)
    return out

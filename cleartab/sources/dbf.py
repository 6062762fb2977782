"""DBF tables through Spark's Python data source API.

Records have a fixed length, so every file is cut into byte ranges that are read
by separate tasks; a task decodes its records in Arrow batches. Every column is
text, so files whose column types drift can be united.
"""

from __future__ import annotations

import datetime
import json
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from cleartab import LINEAGE
from cleartab.functions.text import NULL_TEXTS
from cleartab.sources.listing import UnreachableStorage, open_binary

SPLIT_BYTES = 128 << 20
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Header:
    records: int
    offset: int
    length: int
    fields: tuple[tuple[str, str, int], ...]

    @classmethod
    def read(cls, handle) -> Header:
        start = handle.read(32)
        records, offset, length = struct.unpack("<IHH", start[4:12])
        block = handle.read(offset - 32)
        fields = []
        for at in range(0, len(block) - 31, 32):
            if block[at] == 0x0D:
                break
            name = block[at:at + 11].split(b"\0")[0].decode("latin-1")
            fields.append((name, chr(block[at + 11]), block[at + 16]))
        if 1 + sum(f[2] for f in fields) != length:
            raise ValueError("field sizes do not add up to the record length")
        return cls(records, offset, length, tuple(fields))


def _number(text: str) -> str | None:
    """Digits as an integer, decimals without a bare ``.0``; anything else null."""
    try:
        if "." not in text:
            return str(int(text))
        value = float(text)
        return str(int(value)) if value.is_integer() else str(value)
    except (ValueError, OverflowError):
        return None


def _float(text: str) -> str | None:
    try:
        value = float(text)
        return str(int(value)) if value.is_integer() else str(value)
    except (ValueError, OverflowError):
        return None


def _date(text: str) -> str | None:
    try:
        return datetime.date(int(text[:4]), int(text[4:6]), int(text[6:8])).isoformat()
    except ValueError:
        return None


_TRUE, _FALSE = set("Tyt"), set("NnFf")


def _logical(text: str) -> str | None:
    return "True" if text in _TRUE else "False" if text in _FALSE else None


_DECODERS = {"N": _number, "F": _float, "D": _date, "L": _logical}


def _column(raw: np.ndarray, kind: str) -> pa.Array:
    """Decode each distinct value once."""
    if kind not in ("C", *_DECODERS):
        raise ValueError(f"column type {kind!r} is not supported")
    codes, values = pd.factorize(raw)
    texts = [v.strip().decode("latin-1") for v in values]
    if kind in _DECODERS:
        texts = [_DECODERS[kind](t) for t in texts]
    cleaned = pa.array([None if t is None or t in NULL_TEXTS else t for t in texts], pa.string())
    return cleaned.take(pa.array(codes))


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, files: list[list], split: int):
        self.names = [f.name for f in schema.fields]
        self.files, self.split = files, split

    def partitions(self) -> Sequence[InputPartition]:
        # The reader is sent to every task; the list of files stays here.
        files, self.files = self.files, []
        return [_Range(path, at, min(at + self.split, size))
                for path, size in files for at in range(0, max(size, 1), self.split)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        with open_binary(part.path) as handle:
            head = Header.read(handle)
            first = max(0, -(-(part.start - head.offset) // head.length))
            last = min(head.records, max(0, -(-(part.end - head.offset) // head.length)))
            dtype = np.dtype([("__deleted", "S1"), *((n, f"S{s}") for n, _, s in head.fields)])
            kinds = {n: k for n, k, _ in head.fields}
            source = part.path.rsplit("/", 1)[-1]
            step = max(1, BATCH_BYTES // head.length)
            handle.seek(head.offset + first * head.length)
            for at in range(first, last, step):
                data = handle.read(min(step, last - at) * head.length)
                if len(data) % head.length or not data:
                    raise EOFError(f"{part.path} ends inside a record")
                rows = np.frombuffer(data, dtype)
                rows = rows[rows["__deleted"] == b" "]
                arrays = []
                for name in self.names:
                    if name == LINEAGE:
                        arrays.append(pa.array([source] * len(rows), pa.string()))
                    elif name in kinds:
                        arrays.append(_column(rows[name], kinds[name]))
                    else:
                        arrays.append(pa.nulls(len(rows), pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=self.names)


class DbfSource(DataSource):
    """``files``: JSON list of ``[path, size]``; ``split``: bytes per task."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def _files(self) -> list[list]:
        return json.loads(self.options["files"])

    def schema(self) -> StructType:
        """Union of the columns of all files. Only headers are read; a caller that
        knows the layout passes its schema and skips this."""
        names: dict[str, None] = {}
        for path, _ in self._files():
            with open_binary(path) as handle:
                names.update(dict.fromkeys(f[0] for f in Header.read(handle).fields))
        return StructType([StructField(n, StringType()) for n in [*names, LINEAGE]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self._files(), int(self.options.get("split", SPLIT_BYTES)))


def read_dbf(spark: SparkSession, files: Sequence[tuple[str, int]],
             columns: Sequence[str] | None = None, split: int = SPLIT_BYTES) -> DataFrame:
    """Rows of the given ``(path, size)`` files with the lineage column. ``columns``
    limits and orders the columns (absent ones are null)."""
    spark.dataSource.register(DbfSource)
    reader = (spark.read.format("dbf").option("files", json.dumps([list(f) for f in files]))
              .option("split", split))
    if columns is not None:
        reader = reader.schema(StructType(
            [StructField(c, StringType()) for c in [*columns, LINEAGE]]))
    return reader.load()


def _status(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, name, size in zip(batch["path"], batch["name"], batch["size_bytes"]):
            try:
                with open_binary(path) as handle:
                    head = Header.read(handle)
                if head.offset + head.records * head.length > size:
                    raise EOFError("shorter than its header says")
                rows.append((path, name, size, "ok", head.records, None))
            except UnreachableStorage:
                raise
            except Exception as error:  # one bad file must not stop the others
                rows.append((path, name, size, "failed", None, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(rows, columns=["path", "name", "size_bytes", "status", "n_records",
                                          "error"]).astype({"n_records": "Int64"})


def dbf_status(files: DataFrame) -> DataFrame:
    """Header check of each listed file: ``ok`` or ``failed`` with the reason."""
    spread = files.select("path", "name", "size_bytes").repartition(F.col("path"))
    return spread.mapInPandas(
        _status, "path string, name string, size_bytes bigint, status string, "
                 "n_records bigint, error string")

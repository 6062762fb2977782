"""Fixed-width, delimited and line-JSON scans, all columns as text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from cleartab import LINEAGE
from cleartab.functions.text import strip
from cleartab.sources.listing import first_line, plain

# Field texts that a tabular text reader takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


BLOCK_GAP = 64
"""Characters between two spans from which they are cut from separate blocks."""


def _blocks(spans: Mapping[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches of the line that together hold all spans."""
    blocks: list[tuple[int, int]] = []
    for start, end in sorted(spans.values()):
        if blocks and start - blocks[-1][1] < BLOCK_GAP:
            blocks[-1] = (blocks[-1][0], max(end, blocks[-1][1]))
        else:
            blocks.append((start, end))
    return blocks


def slice_lines(lines: DataFrame, line: str, spans: Mapping[str, tuple[int, int]],
                keep: Sequence[str] = ()) -> DataFrame:
    """Half-open character spans of a line as trimmed columns; missing -> ``''``.
    Lines that are blank in all spans are dropped.

    Finding a position walks the text from its start, so a long line is first
    cut into a few blocks and the columns are cut from these.
    """
    blocks = _blocks(spans)
    block_of = {name: next(i for i, (a, b) in enumerate(blocks) if a <= start and end <= b)
                for name, (start, end) in spans.items()}
    cut = lines.select(*keep, *[F.substring(line, a + 1, b - a).alias(f"__b{i}")
                                for i, (a, b) in enumerate(blocks)])
    fields = cut.select(*keep, *[
        strip(F.substring(f"__b{block_of[n]}", start - blocks[block_of[n]][0] + 1, end - start)).alias(n)
        for n, (start, end) in spans.items()])
    filled = fields.filter(reduce(or_, [F.col(f"`{n}`") != "" for n in spans]))
    out = []
    for name, (start, end) in spans.items():
        missing = [m for m in MISSING_TEXTS if 0 < len(m) <= end - start]
        value = F.col(f"`{name}`")
        out.append((F.when(value.isin(missing), F.lit("")).otherwise(value) if missing else value)
                   .alias(name))
    return filled.select(*keep, *out)


def read_fixed_width(spark: SparkSession, path: str | Sequence[str],
                     spans: Mapping[str, tuple[int, int]], lineage: bool = False) -> DataFrame:
    """One row per line, optionally with the name of its file."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    if not lineage:
        return slice_lines(lines, "value", spans)
    named = lines.select("value", F.col("_metadata.file_name").alias(LINEAGE))
    return slice_lines(named, "value", spans, [LINEAGE])


BAD_LINE = "_bad_line"


def _by_header(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> list[list[str]]:
    """The files, grouped by their first line, of which only the first bytes are
    read, several files at a time. One file is not looked into."""
    files = [plain(spark, f) for f in spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()]
    if len(files) < 2:
        return [[f] for f in files]
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: first_line(spark, f, encoding), files))
    groups: dict[str, list[str]] = {}
    for header, file in sorted(zip(headers, files), key=lambda x: x[1]):
        groups.setdefault(header or "", []).append(file)
    return list(groups.values())


def read_delimited(spark: SparkSession, path: str | Sequence[str], separator: str = ";",
                   encoding: str = "UTF-8", multiline: bool = False, bad_lines: bool = False) -> DataFrame:
    """Header, all text, no inference. A byte-order mark is dropped by the reader.
    Multi-line values make a file unsplittable, so they are an option.

    Files are read under their own header and united by name. A line with fewer
    cells than the header is filled with nulls. A line with more stops the read;
    with ``bad_lines`` it is kept instead, marked by its cells in ``_bad_line``.
    """
    def one_layout(files: list[str]) -> DataFrame:
        reader = (spark.read.option("sep", separator).option("header", True)
                  .option("encoding", encoding).option("escape", '"').option("multiLine", multiline))
        columns = reader.csv(files[0]).columns
        # One cell more than the header has shows a line that is too long.
        schema = StructType([StructField(c, StringType()) for c in [*columns, "__surplus"]])
        rows = reader.schema(schema).csv(files)
        line = F.concat_ws(separator, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rows.columns])
        long = F.col("__surplus").isNotNull()
        cells = [F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in columns]
        if bad_lines:
            return rows.select(*cells, F.when(long, line).alias(BAD_LINE))
        stop = F.raise_error(F.concat(F.lit("more cells than the header names: "), line)).cast("string")
        return rows.select(F.when(long, stop).otherwise(cells[0]).alias(columns[0]), *cells[1:])

    parts = [one_layout(files) for files in _by_header(spark, path, encoding)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Texts of scalar types in a found schema, and the column type each becomes. All others (mixed types, objects,
# lists, whole numbers past 64 bits, nothing but nulls) stay text.
_SCALARS = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def ndjson_fields(spark: SparkSession, path: str | Sequence[str], typed: bool = False) -> dict[str, str]:
    """Fields of the objects in line-JSON files, by name, with their column type.

    Every line is parsed once and the shapes are merged as aggregates, so a field
    that one line in a billion has is found. All columns are text; ``typed`` gives
    those their type whose values are all whole numbers, numbers or truth values.
    Lines that are no object are passed over.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(F.try_parse_json("value").alias("v"))
    shape = F.schema_of_variant_agg(F.when(F.schema_of_variant("v").startswith("OBJECT<"), F.col("v")))
    found = lines.agg(shape.alias("s")).first().s
    if not (found or "").startswith("OBJECT<"):
        return {}
    # A back-quoted name is left alone, whatever it holds.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    fields = DataType.fromDDL(ddl).fields

    def kind(dtype: DataType) -> str:
        name = dtype.simpleString().upper()
        if name.startswith("DECIMAL") and not name.endswith(",0)"):
            return "double"
        return _SCALARS.get(name, "string")

    return {f.name: kind(f.dataType) if typed else "string" for f in fields}


def read_ndjson(spark: SparkSession, path: str | Sequence[str], fields: Sequence[str] | None = None,
                bad_lines: bool = False, typed: bool = False) -> DataFrame:
    """Line JSON with every field as text: nested values arrive as raw JSON,
    numbers as digits, absent fields as null. Files need not share a layout.

    Without ``fields`` the columns are those of all objects in all files, united by
    name in alphabetical order (see ``ndjson_fields``, also for ``typed``).
    ``bad_lines`` adds ``_bad_line`` with the text of lines that are no JSON;
    otherwise such a line stops the read.
    """
    kinds = ndjson_fields(spark, path, typed) if fields is None else dict.fromkeys(fields, "string")
    schema = ", ".join("`{}` {}".format(f.replace("`", "``"), kind) for f, kind in kinds.items())
    reader = spark.read.option("mode", "FAILFAST")
    if bad_lines:
        schema += f"{', ' if schema else ''}{BAD_LINE} string"
        reader = (spark.read.option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", BAD_LINE))
    return reader.schema(schema).json(path if isinstance(path, str) else list(path))


def read_parquet_union(spark: SparkSession, path: str | Sequence[str],
                       lineage: bool = False) -> DataFrame:
    """Parquet files united by name; columns may differ from file to file."""
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    return rows.withColumn(LINEAGE, F.col("_metadata.file_name")) if lineage else rows

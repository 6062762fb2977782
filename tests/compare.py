"""Compare registered queries with their SQL.

``python -m tests.compare [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def kind(dtype: str) -> str:
    dtype = dtype.lower()
    for names, kind_ in ((("bigint", "int", "integer", "hugeint", "smallint", "tinyint"), "whole"),
                         (("double", "float"), "float"), (("string", "varchar"), "text")):
        if dtype in names or dtype.startswith("decimal") and kind_ == "float":
            return kind_
    return dtype.split("_")[0]


def differences(df, con, sql: str) -> list[str]:
    columns = sorted(df.columns)
    result = con.execute(sql)
    types = {d[0]: kind(str(d[1])) for d in result.description}
    want = result.fetchall()
    names = [d[0] for d in result.description]
    if columns != sorted(names):
        return [f"columns {columns} / {sorted(names)}"]
    ours = {c: kind(t) for c, t in df.dtypes}
    wrong = [f"type of {c}: {ours[c]} / {types[c]}" for c in columns if ours[c] != types[c]]
    at = [names.index(c) for c in columns]
    have = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    expected = Counter(tuple(plain(r[i]) for i in at) for r in want)
    if have != expected:
        wrong.append(f"rows {sum(have.values())} / {sum(expected.values())}")
        wrong += [f"  only here {k}"[:400] for k in list((have - expected))[:3]]
        wrong += [f"  only SQL  {k}"[:400] for k in list((expected - have))[:3]]
    return wrong


def main(arguments: list[str]) -> int:
    from cleartab import queries
    from cleartab.session import build

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build(master=f"local[{os.cpu_count()}]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries.load()
    con, bad = connect(folder), 0
    for name in arguments[1:] or list(queries.QUERIES):
        start = time.time()
        try:
            df = queries.QUERIES[name](spark, folder)
            wrong = differences(df, con, queries.ORACLES[name]) if name in queries.ORACLES else [
                f"no SQL, {df.count()} rows"]
        except Exception as error:
            wrong = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(wrong)
        print(f"{'ok  ' if not wrong else 'FAIL'} {name} {time.time() - start:.1f}s", *wrong, sep="\n     " if wrong else " ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

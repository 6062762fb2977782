"""Snapshots, levelled runs, boundaries, slices by bisection, concurrent units, bitmaps, found fields, SQL hooks."""

import bisect
import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.functions.search import at_or_below
from cleartab.operators import columns, ordered, publish, relational, slices, snapshots
from cleartab.plans import incremental
from cleartab.session import Staging
from cleartab.sources import listing, text
from cleartab.streaming import documents


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), f"id int, {LINEAGE} string")


def rows(df):
    return sorted(tuple(r) for r in df.select("id", LINEAGE).collect())


def test_snapshot_steps(spark, tmp_path, monkeypatch):
    """Whatever step a writer stops at, the table is the old one or the new one; a reader of a version keeps its files."""
    path = str(tmp_path / "t")
    snapshots.replace_sources(batch(spark, (1, "A.dbf"), (2, "B.dbf")), path, ["A.dbf", "B.dbf"])
    old, held = [(1, "A.dbf"), (2, "B.dbf")], snapshots.read(spark, path)
    change = batch(spark, (7, "a.DBF"))
    for module, name in ((snapshots, "write_folder"), (publish, "children_by_source"), (snapshots, "commit")):
        def stop(*_, **__):
            raise RuntimeError("stopped")
        with monkeypatch.context() as m:
            m.setattr(module, name, stop)
            with pytest.raises(RuntimeError):
                snapshots.replace_sources(change, path, ["a.DBF"])
        assert rows(snapshots.read(spark, path)) == old
    assert snapshots.replace_sources(change, path, ["a.DBF", "b.dbf"]) == 1
    assert rows(snapshots.read(spark, path)) == [(7, "a.DBF")] and rows(held) == old
    assert rows(snapshots.read(spark, path, 0)) == old
    with pytest.raises(ValueError, match="outside the batch"):
        snapshots.replace_sources(change, path, ["other"])
    assert snapshots.replace_sources(change.limit(0), path, ["A.DBF"]) == 0
    empty = snapshots.read(spark, path)
    assert empty.count() == 0 and empty.dtypes == [("id", "int"), (LINEAGE, "string")]


def test_snapshot_columns_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace_sources(batch(spark, (1, "0012")), path, ["0012"])
    more = batch(spark, (2, "2020")).withColumn("extra", F.lit("x"))
    snapshots.replace_sources(more, path, ["2020"])
    now = snapshots.read(spark, path)
    assert sorted(map(tuple, now.select("id", LINEAGE, "extra").collect())) == [(1, "0012", None), (2, "2020", "x")]
    with pytest.raises(ValueError, match="column id was"):
        snapshots.replace_sources(batch(spark, (3, "x")).withColumn("id", F.lit("text")), path, ["x"])
    snapshots.overwrite(now.filter("id = 2"), path)
    assert snapshots.vacuum(spark, path, keep=1, older_than_ms=86_400_000) == 0
    assert snapshots.vacuum(spark, path, keep=1, older_than_ms=0) == 3
    assert snapshots.read(spark, path).count() == 1 and snapshots.versions(spark, path) == [2]
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, str(tmp_path / "none"))


def test_snapshot_writers(spark, tmp_path):
    """Of writers from one version one wins and the others fail; edits that may be repeated all get in."""
    path = str(tmp_path / "t")
    snapshots.overwrite(spark.range(1), path)
    at, now = snapshots.state(spark, path)
    done, failed = [], []

    def write():
        try:
            done.append(snapshots.commit(spark, path, at + 1, now))
        except snapshots.Conflict:
            failed.append(1)

    def add(i):
        snapshots.change(spark, path, lambda s: s | {"seen": sorted([*s.get("seen", []), i])})

    snapshots._rename(spark, f"{path}/other.json", b"{}")
    with pytest.raises(FileExistsError):
        snapshots._rename(spark, f"{path}/other.json", b"{}")
    for work in ([threading.Thread(target=write) for _ in range(4)], [threading.Thread(target=add, args=(i,)) for i in range(4)]):
        for t in work:
            t.start()
        for t in work:
            t.join()
    assert len(done) == 1 and len(failed) == 3
    assert snapshots.state(spark, path)[1]["seen"] == [0, 1, 2, 3]
    assert not [n for n in listing.children(spark, f"{path}/{snapshots.LOG}") if n.startswith(".") and not n.endswith(".crc")]


def test_runs_and_compaction(spark, tmp_path):
    """Batches become runs, full levels are merged, a repeated batch is taken once, a merge keeps what came in meanwhile."""
    store, order = str(tmp_path / "s"), [F.col("seen").desc()]
    want = {}
    for number in range(11):
        new = {f"d{(number * 3 + i) % 7}": f"{number:03d}" for i in range(3)}
        want |= new
        one = spark.createDataFrame(list(new.items()), "id string, seen string")
        for _ in range(2):
            documents._add(spark, f"{store}/documents", "run", number, one)
        documents.compact(spark, store, ["id"], order, fanout=3)
        runs = documents.live_rows(spark, store)
        assert all(len(r) < 3 for r in runs.values()) and all(n <= 7 for r in runs.values() for n in r)
        got = {r.id: r.seen for r in documents.current(spark, store, ["id", "seen"], ["id"], order).collect()}
        assert got == want
    assert documents.live_rows(spark, store) == {0: [3, 3], 2: [7]}
    assert documents.compact(spark, store, ["id"], order, whole=True) == 1
    assert documents.live_rows(spark, store) == {2: [7]}
    assert {r.id: r.seen for r in documents.current(spark, store, ["id", "seen"], ["id"], order).collect()} == want
    none = documents.current(spark, str(tmp_path / "no"), ["id", "seen"], ["id"], order)
    assert none.count() == 0 and none.columns == ["id", "seen"]


def test_far_value_moves_no_boundary(spark):
    df = spark.range(40_000).select(F.when(F.col("id") == 39_999, 10 ** 12).otherwise(F.col("id")).alias("at")).repartition(4)
    sizes = [r["count"] for r in ordered._stretched(df, "at", None, 1000).groupBy("__stretch").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    numbered = ordered.occurrence_number(df.withColumn("g", F.lit(1)), ["g"], "at", "n", rows=1000)
    assert numbered.filter(F.col("n") != F.least(F.col("at"), F.lit(39_999)) + 1).count() == 0
    few = spark.createDataFrame([(5.5,), (None,), (5.5,)], "at double")
    assert {r["__stretch"] for r in ordered._stretched(few, "at", None, 1).collect()} <= {0, 1}
    assert ordered._stretched(few.limit(0), "at", None, 1).count() == 0


def test_bisection(spark):
    draw = random.Random(4)
    lists = [sorted(draw.sample(range(50), draw.randrange(12))) for _ in range(60)]
    df = spark.createDataFrame([(b, v) for b in lists for v in (-1, 0, 17, 30, 60, None)], "b array<int>, v int")
    for r in df.select("b", "v", at_or_below(F.col("b"), F.col("v")).alias("n")).collect():
        assert r.n == (0 if r.v is None else bisect.bisect_right(r.b, r.v))


def test_slices_overlap(spark):
    """Of overlapping slices the first listed counts, as one comparison after the other would have it."""
    draw = random.Random(9)
    days = [f"{draw.randrange(1990, 2003)}{draw.choice(['', '-'])}{draw.randrange(1, 13):02d}" for _ in range(400)] + [None, "", "x", "9999"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    for prefixes in ([], ["1995"], ["199503", "1995", "199504", "1994", "200012"], ["1995", "199503"], ["9999", "1999"],
                     draw.sample([f"{y}{m:02d}" for y in range(1990, 2003) for m in range(1, 13)], 90) + ["1996"]):
        def first(d):
            return next((p for p in prefixes if d is not None and slices.bounds(p)[0] <= d < slices.bounds(p)[1]), None)
        got = df.select("d", slices.slice_of(F.col("d"), prefixes).alias("s"), slices.residual(F.col("d"), prefixes).alias("r")).collect()
        assert [(r.s, r.r) for r in got] == [(first(r.d), first(r.d) is None) for r in got]


def test_units_side_by_side(spark):
    """Two units wait for each other, which only works side by side; groups and pools are their own; a slow unit is cancelled."""
    both, seen = threading.Barrier(2, timeout=60), {}

    def work(unit):
        seen[unit] = spark.sparkContext.getLocalProperty("spark.jobGroup.id"), spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if unit == "slow":
            return spark.range(0, 1 << 42, 1, 1).filter("id % 1000003 = -1").count()
        if unit == "bad":
            raise KeyError("x")
        both.wait()
        return spark.range(5).count()

    begun = time.monotonic()
    got = {r.unit: r for r in publish.isolated(spark, ["a", "slow", "b", "bad"], work, seconds=8).collect()}
    assert {u: r.status for u, r in got.items()} == {"a": "processed", "b": "processed", "slow": "cancelled", "bad": "failed"}
    assert got["a"].n_rows == 5 and "8 seconds" in got["slow"].error and "KeyError" in got["bad"].error
    assert time.monotonic() - begun < 120 and len(set(seen.values())) == 4
    assert publish.isolated(spark, [], work).count() == 0


def test_publish_counts_in_one_job(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish-once", "")
    assert publish.publish(spark.range(1234).repartition(3), str(tmp_path / "t")) == 1234
    written = len(tracker.getJobIdsForGroup("publish-once"))
    spark.sparkContext.setJobGroup("write-only", "")
    spark.range(1234).repartition(3).write.parquet(str(tmp_path / "u"))
    assert written == len(tracker.getJobIdsForGroup("write-only"))
    spark.sparkContext._jsc.clearJobGroup()
    assert publish.publish(spark.range(3).filter("id > 9"), str(tmp_path / "none")) == 0


def test_catalog_lines(spark, tmp_path):
    names = [f"f{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)
    odd = 'a "b", c'
    df = spark.createDataFrame([(n, odd, "x", i, 1, 1, "t") for i, n in enumerate(names)], ", ".join(
        f"{c} {'bigint' if c.startswith(('num', 'tam')) else 'string'}" for c in publish.CATALOG_COLUMNS)).repartition(5)
    path = tmp_path / "c"
    publish.write_catalog(df, str(path), rows_per_file=60)
    parts = sorted(path.glob("part-*"))
    lines = [x for p in parts for x in p.read_text().splitlines()]
    assert len(parts) > 5 and lines[0] == "﻿" + ",".join(publish.CATALOG_COLUMNS) and len(lines) == 501
    assert [x.split(",")[0] for x in lines[1:]] == sorted(names)
    back = publish.read_catalog(spark, str(path))
    assert back.count() == 500 and back.filter(F.col("diretorio") == odd).count() == 500
    publish.write_catalog(df.limit(0), str(tmp_path / "d"))
    assert publish.read_catalog(spark, str(tmp_path / "d")).count() == 0


def test_bitmaps(spark):
    draw = random.Random(3)
    ids = ["1", "01", "12345678901234567890", "123456789012345678901", "12345678901234567891", "x", "", "999999", "1000000", None]
    data = [(draw.choice("abc"), draw.choice(ids)) for _ in range(300)]
    maps = relational.entity_bitmaps(spark.createDataFrame(data, "g string, e string"), "g", "e")
    want = {g: len({e for h, e in data if h == g and e is not None}) for g in "abc"}
    assert {r.g: r.n_entities for r in relational.entities_in(maps, ["g"]).collect()} == want
    assert relational.entities_in(maps).first()[0] == len({e for _, e in data if e is not None})
    assert relational.entities_in(maps.limit(0)).first()[0] == 0


def test_bitmaps_without_neighbours(spark):
    """An entity alone in its bucket takes one long; neighbours share one, up to both ends of it."""
    lone = spark.range(2_000).selectExpr("'a' AS g", "IF(id % 2 = 0, 'case ' || id, id || '00012345678901') AS e")
    dense = spark.range(640).selectExpr("'b' AS g", "CAST(id + 1000000 AS STRING) AS e")
    maps = relational.entity_bitmaps(lone.unionAll(dense).unionAll(dense), "g", "e")
    sizes = maps.selectExpr("g", "length(CAST(bits AS STRING)) AS n").groupBy("g").agg(F.count("*").alias("rows"), F.max("n").alias("most"))
    assert {r.g: (r["rows"], r["most"] <= 20) for r in sizes.collect()} == {"a": (2_000, True), "b": (10, True)}
    assert {r.g: r.n_entities for r in relational.entities_in(maps, ["g"]).collect()} == {"a": 2_000, "b": 640}
    assert relational.entities_in(maps).first()[0] == 2_640


def test_found_fields(spark, tmp_path):
    """Fields of all lines, odd names and mixed types included; a line that is no object adds none."""
    lines = [{"a": 1, "b": "x", "c": {"d": 1}, "e f": True, "g`h": 1.5, "n": None, "OBJECT<": 1}, {"a": 2, "b": 3, "c": [1], "g`h": 2},
             {"big": 12345678901234567890}]
    (tmp_path / "x.json").write_text("\n".join(json.dumps(x, separators=(",", ":")) for x in lines))
    path = str(tmp_path / "x.json")
    assert text.ndjson_fields(spark, path, typed=True) == {
        "a": "bigint", "b": "string", "big": "string", "c": "string", "e f": "boolean", "g`h": "double", "n": "string", "OBJECT<": "bigint"}
    got = text.read_ndjson(spark, path, typed=True).collect()
    assert (got[0]["a"], got[0]["b"], got[0]["c"], got[0]["e f"], got[0]["g`h"], got[0]["OBJECT<"]) == (1, "x", '{"d":1}', True, 1.5, 1)
    assert (got[1]["b"], got[1]["c"], got[1]["g`h"], got[2]["big"]) == ("3", "[1]", 2.0, "12345678901234567890")
    assert text.read_ndjson(spark, path).schema["a"].dataType.simpleString() == "string"
    (tmp_path / "bad.json").write_text('{"a":1}\nbroken\n[1]\n')
    bad = text.read_ndjson(spark, str(tmp_path / "bad.json"), bad_lines=True)
    assert bad.columns == ["a", text.BAD_LINE] and bad.filter(F.col("a") == "1").count() == 1
    (tmp_path / "none.json").write_text("")
    assert text.ndjson_fields(spark, str(tmp_path / "none.json")) == {}


def test_first_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b c.csv").write_text("y;x\n3;4\n")
    (tmp_path / "e.csv").write_text("")
    spark.createDataFrame([("x;y",), ("5;6",)], "v string").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "z"))
    got = text.read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b c.csv"), str(tmp_path / "z")])
    assert sorted(map(tuple, got.select("x", "y").collect())) == [("1", "2"), ("4", "3"), ("5", "6")]


def test_sql_hook(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    hook = incremental.sql_hook("SELECT '{' || k || '}' AS k, v * 2 AS v FROM __ORIGEM__ WHERE v >= :least", least=2)
    assert [tuple(r) for r in hook(df).collect()] == [("{b}", 4)]
    assert [tuple(r) for r in hook(df.filter("v < 2")).collect()] == []
    with pytest.raises(ValueError):
        incremental.sql_hook("SELECT 1")


def test_keep_listed(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "z")], "id int, `x.y` string, z string")
    kept, report = columns.keep_listed(df, ["id", "none"])
    assert kept.columns == ["id"] and kept.count() == 2
    assert sorted(map(tuple, report.collect())) == [("x.y", 2, 1), ("z", 2, 1)]
    assert columns.keep_listed(df, df.columns)[1].count() == 0


def test_global_numbers(spark):
    with Staging(spark) as area:
        df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(6)
        got = ordered.numbered(df, [F.col("k").desc()], "n", area)
        pairs = sorted((r.n, r.k) for r in got.collect())
    assert [n for n, _ in pairs] == list(range(1, 5001)) and [k for _, k in pairs] == sorted((k for _, k in pairs), reverse=True)

"""Order-dependent operators give the same result however groups are cut."""

import random

import pytest
from pyspark.sql import functions as F

from cleartab.operators import ordered, relational, slices, versions
from cleartab.session import Staging


@pytest.mark.parametrize("stretch", [1, 3, 7, 1000, None])
def test_forward_fill_and_occurrence(spark, stretch):
    rng = random.Random(stretch or 0)
    rows, want, counts = [], {}, {}
    for group in ("hot", "cold", None):
        current, n = None, 0
        for at in sorted(rng.sample(range(200), 120 if group == "hot" else 12)):
            mark = rng.choice(["a", "b", None, None, "reset"])
            rows.append((group, at, mark))
            current = None if mark == "reset" else mark or current
            n += 1
            want[(group, at)], counts[(group, at)] = current, n
    df = spark.createDataFrame(rows, "g string, at int, mark string").repartition(3)
    reset = F.col("mark") == "reset"
    filled = ordered.forward_fill(df, ["g"], "at", F.when(~reset, F.col("mark")), reset, "v", stretch)
    assert {(r.g, r.at): r.v for r in filled.collect()} == want
    numbered = ordered.occurrence_number(df, ["g"], "at", "n", stretch)
    assert {(r.g, r.at): r.n for r in numbered.collect()} == counts


def test_bounds():
    assert slices.bounds("2024") == ("2024", "2025")
    assert slices.bounds("202403") == ("202403", "202404")
    assert slices.bounds("202412") == ("202412", "202501")


def test_slices_and_residual_cover_all(spark):
    days = ["20240115", "2024-01-15", None, "20231231", "202412", "x"]
    df = spark.createDataFrame([(d,) for d in days], "day string")
    covered = ["2023", "202401", "202412"]
    inside = df.filter(F.coalesce(*[F.when(slices.in_slice(F.col("day"), p), F.lit(1)) for p in covered]) == 1)
    outside = df.filter(slices.residual(F.col("day"), covered))
    assert inside.count() + outside.count() == len(days)
    assert {r.day for r in outside.collect()} == {"2024-01-15", None, "x"}


def test_untrusted_counts_keep_years_whole(spark):
    def plan(rows, *args, **kwargs):
        df = spark.createDataFrame(rows, "y int, m int")
        with Staging(spark) as area:
            return {r.slice: r.n for r in slices.slice_plan(df, F.col("y"), F.col("m"), area, *args, **kwargs).collect()}

    undated = [(2020, 1)] * 10 + [(None, None)] * 15
    assert plan(undated, 5) == {"2020": 10}
    assert plan(undated, 5, years=(2019, 2021)) == {"2019": 0, "2020": 10, "2021": 0}
    dated = [(2020, 1)] * 10 + [(2022, 3)] * 2
    assert plan(dated, 5) == {"202001": 10, "2022": 2}
    assert plan(dated, 5, total=100, years=(2020, 2022)) == {"2020": 10, "2021": 0, "2022": 2}
    assert plan(dated, 100, years=(2020, 2022)) == {"2020": 10, "2021": 0, "2022": 2}
    assert plan([(2020, None)] * 10 + [(2020, 2)], 5) == {f"2020{m:02d}": int(m == 2) for m in range(1, 13)}
    assert plan([], 5) == {}


def scans(df):
    """File scans of the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")


def test_one_pass(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 5 AS k", "string(id) AS t").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert scans(versions.latest_version(rows, ["k"], [F.col("id").desc()], scanned=True)) == 1
    assert scans(relational.nested_counts(rows, {"a": F.col("k") == 1, "b": F.col("k") < 3})) == 1
    assert relational.subset_violations(rows.filter("k < 2"), rows.filter("k < 1"), "id").count() == 10


def test_reconcile(spark):
    loaded = spark.createDataFrame([("a",), ("a",), ("b",)], "unit string")
    declared = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("c", 1)], "unit string, n bigint")
    got = {r.unit: (r.diff, r.complete) for r in slices.reconcile(loaded, declared, "unit").collect()}
    assert got == {"a": (0, True), "b": (1, False), "c": (1, False)}

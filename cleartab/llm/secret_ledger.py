"""Incremental secret scan over a ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger
records which rules (kind and version) have been run on which blob; a scan
reads only blobs with rules still missing and runs only those rules. Findings
are kept per blob and joined back to every path that ever held it. DataFrame
functions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleartab.llm.common import documents
from cleartab.session import staging_path


@dataclass(frozen=True)
class Rule:
    """All leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}\n{self.group}\n{self.least}".encode()).hexdigest()[:12]

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Kinds and patterns of the contract. The bounds of the last two are
# part of the pattern, which selects the same maximal runs as dropping short ones.
_NAMES = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in
                        ("password", "passwd", "secret", "token", "api_?key")) + ")"
BASE = [
    Rule("assign", _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
# Published formats of further credentials.
MORE = [
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url", r"\b[a-z][a-z0-9+.-]{1,10}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
]
RULES = BASE + MORE
EARLIER = [Rule("forge", r"\bghp_[A-Za-z0-9]{36,}") if r.kind == "forge" else r for r in RULES]
"""The rules as they were before one of them was widened."""

HIT = T.StructType([T.StructField("rule", T.StringType()), T.StructField("gap", T.IntegerType()),
                    T.StructField("length", T.IntegerType()), T.StructField("counts", T.BooleanType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rules", T.ArrayType(T.StringType())),
                       T.StructField("hits", T.ArrayType(HIT))])


def blobs(versions: DataFrame) -> DataFrame:
    """The versions with the address of their content; a null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.withColumn("text", text).withColumn("blob", F.sha2(text, 256))


def _hits(rule: Rule) -> Column:
    """Gap before and length of each match. Matches are cut out of the text, so lengths of the pieces between
    them place them, in code points and without searching again."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    parts = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else found
    between = F.split("text", rule.pattern, -1)
    each = F.transform(F.arrays_zip(found.alias("whole"), parts.alias("part"), F.slice(between, 1, F.size(found)).alias("gap")),
                       lambda x: F.struct(F.lit(rule.name).alias("rule"), F.length(x["gap"]).alias("gap"),
                                          F.length(x["whole"]).alias("length"),
                                          (F.length(x["part"]) >= rule.least).alias("counts")))
    return F.when(F.col("text").rlike(rule.pattern), each).otherwise(F.array().cast(T.ArrayType(HIT)))


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: list[Rule]) -> DataFrame:
    """One row (blob, text, missing) per blob on which some rule has not been run.

    Addresses meet the ledger first; texts are fetched only for blobs with
    something missing, and where these are few, known texts are not shuffled.
    """
    every = F.array(*[F.lit(r.name) for r in rules])
    held = blobs(versions).select("blob", "text")
    if ledger is None:
        return held.dropDuplicates(["blob"]).withColumn("missing", every)
    known = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
    missing = F.array_except(every, F.coalesce(F.col("known"), F.array().cast("array<string>")))
    todo = (held.select("blob").distinct().join(known, "blob", "left").select("blob", missing.alias("missing"))
            .filter(F.size("missing") > 0))
    return held.join(todo, "blob").dropDuplicates(["blob"])


def scan(todo: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ledger rows for unseen blobs: the rules run and their raw hits."""
    none = F.array().cast(T.ArrayType(HIT))
    hits = [F.when(F.array_contains("missing", r.name), _hits(r)).otherwise(none) for r in rules]
    return todo.select("blob", F.col("missing").alias("rules"), F.concat(*hits).alias("hits"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def update(spark: SparkSession, versions: DataFrame, path: str, rules: list[Rule] = RULES) -> DataFrame:
    """Scans what the ledger at ``path`` has not seen, appends it in one atomic write, and returns the ledger."""
    scan(unseen(versions, read_ledger(spark, path), rules), rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def spans(ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Findings of the current rules: (blob, kind, order, start, end), positions in code points, end exclusive."""
    names = [r.name for r in rules]
    one = ledger.filter(F.size("hits") > 0).select("blob", F.posexplode("hits").alias("at", "hit"))
    one = one.select("blob", "at", "hit.*").filter(F.col("rule").isin(names))
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    one = one.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(upto)).filter("counts")
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("rule")).cast("int")
    return one.select("blob", F.split_part("rule", F.lit("@"), F.lit(1)).alias("kind"), order.alias("order"),
                      (F.col("end") - F.col("length")).alias("start"), "end")


def findings(versions: DataFrame, ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Every path with the findings of its blob, by start, then rule order.

    A path without findings has an empty list. Repeated paths each keep their
    row; further columns of the input stay, but for ``blob`` and ``findings``, which
    are replaced; an empty table gives no rows.
    """
    lists = spans(ledger, rules).groupBy("blob").agg(F.sort_array(F.collect_list(
        F.struct("start", "order", "end", "kind"))).alias("findings"))
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    return (blobs(versions.drop("findings")).drop("text").join(lists, "blob", "left")
            .withColumn("findings", F.coalesce("findings", none)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Two scans of all documents: the second one, after a rule has changed, runs that rule only."""
    docs = documents(spark, folder).select("doc_id", "text")
    path = staging_path(spark, "secret_ledger")
    update(spark, docs, path, EARLIER)
    ledger = update(spark, docs, path)
    base = F.filter("findings", lambda x: x["order"] <= len(BASE))
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return findings(docs, ledger).select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))

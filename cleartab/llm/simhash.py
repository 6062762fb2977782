"""SimHash fingerprints and search by Hamming distance, in DataFrame functions only.

Terms are word 5-grams, a shorter text being one term. Each occurrence votes
with the bits of its 64-bit hash, so a term weighs its frequency; a bit of the
fingerprint is set where more votes are for than against. Two counters share a
long, so 32 sums count the votes for all 64 bits.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.common import documents, in_stretches, keep_only, whole_text, words
from cleartab.session import Staging

TERM_WORDS = 5
BLOCKS = 6
RADIUS = 3
QUERY_EVERY = 50

_LANES = 0x0000000100000001


def terms(text: Column, n: int = TERM_WORDS) -> Column:
    """Hashes of all word n-grams in order; of the whole sequence where it is shorter; none without words."""
    def of(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - (n - 1), F.lit(1)))
        grams = F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, n)))
        return F.when(F.size(found) > 0, grams)

    # As a lambda's variable the words are split once, not once per n-gram.
    return F.get(F.transform(F.array(words(text)), of), 0)


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The keys, which tell the rows apart, and ``fingerprint`` (long) of each text. A text without words has 0."""
    votes = texts.select(*keys, F.explode_outer(terms(F.col(text))).alias("term"))
    lane = lambda i: F.sum(F.shiftrightunsigned("term", i).bitwiseAND(F.lit(_LANES)))
    sums = votes.groupBy(*keys).agg(*[lane(i).alias(f"s{i}") for i in range(32)], F.count("term").alias("total"))
    half = F.col("total")
    bits = []
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{i}", 32)
        for value, at in ((low, i), (high, i + 32)):
            bit = (1 << at) if at < 63 else -(1 << 63)
            bits.append(F.when(value * 2 > half, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    fingerprint = bits[0]
    for bit in bits[1:]:
        fingerprint = fingerprint.bitwiseOR(bit)
    return sums.select(*keys, F.coalesce(fingerprint, F.lit(0).cast("long")).alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def text_form(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _tables(blocks: int, radius: int) -> list[int]:
    """Masks of the bits that each table looks up: all choices of blocks - radius blocks.

    Fingerprints within the radius differ in at most ``radius`` blocks and so agree on one choice at least.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in itertools.combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def neighbours(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All (query_print, fingerprint) with at most ``radius`` different bits.

    ``queries`` and ``prints`` hold distinct long fingerprints in a column of
    that name. Permuted blocks of the bits are keys of as many tables. A pair is
    reported by the first table in which it meets, so none is reported twice.
    """
    masks = _tables(blocks, radius)
    def keyed(df, name):
        rows = [F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")).alias("k"))
                for t, m in enumerate(masks)]
        return df.select(F.col("fingerprint").alias(name), F.inline(F.array(*rows)))
    apart = F.col("query_print").bitwiseXOR(F.col("fingerprint"))
    first = F.lit(len(masks))
    for t, m in reversed(list(enumerate(masks))):
        first = F.when(apart.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)).otherwise(first)
    met = keyed(queries, "query_print").join(keyed(prints, "fingerprint"), ["t", "k"])
    return met.filter((F.bit_count(apart) <= radius) & (first == F.col("t"))).select("query_print", "fingerprint")


def _successors(docs: DataFrame, staging: Staging) -> DataFrame:
    """One row per key, which stands for an id, null included: the key of the next lower id (after the least the
    greatest), the key whose next this one is and how much of the text that one takes, and which of the id's texts
    stands for it (the one of least hash)."""
    ids = docs.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("stands"),
                                  F.max("n_chars").alias("n_chars"))
    cut = in_stretches(ids, [F.col("doc_id")], staging, "ids")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    edges = cut.groupBy("_part").agg(F.min_by("key", place).alias("low"), F.max_by("key", place).alias("high"),
                                     F.min_by("n_chars", place).alias("n_low"))
    whole, order = Window.partitionBy(), Window.orderBy("_part")
    edges = edges.select("_part",
                         F.coalesce(F.lag("high").over(order), F.max_by("high", "_part").over(whole)).alias("before"),
                         F.coalesce(F.lead("low").over(order), F.min_by("low", "_part").over(whole)).alias("after"),
                         F.coalesce(F.lead("n_low").over(order), F.min_by("n_low", "_part").over(whole)).alias("n_after"))
    inside = Window.partitionBy("_part").orderBy("doc_id")
    rows = cut.select("_part", "key", "stands", F.lag("key").over(inside).alias("down"),
                      F.lead("key").over(inside).alias("up"), F.lead("n_chars").over(inside).alias("n_up"))
    return rows.join(edges, "_part").select(
        "key", "stands", F.coalesce("down", "before").alias("next_key"), F.coalesce("up", "after").alias("borrower"),
        F.floor(F.coalesce("n_up", "n_after") / 2).cast("int").alias("lent"))


def compare(spark: SparkSession, docs: DataFrame, staging: Staging) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, and their likeness.

    The next document is that of the next lower id, after the least the
    greatest. Rows that share an id share the next document; where the next id
    has several texts, the one of least hash stands for it. A null id sorts
    lowest. A null text is empty and has fingerprint 0, as has one without
    words. A lone document is next to itself. An empty table gives no rows;
    other columns are not read. Likeness is the share of equal bits.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = keep_only(docs, "doc_id", "text").select(key.alias("key"), "doc_id", whole_text(docs).alias("text"))
    hashed = rows.select("key", "doc_id", F.xxhash64("text").alias("text_hash"), F.length("text").alias("n_chars"))
    order = staging.table(_successors(hashed, staging), "order")
    # Both uses of the placed texts read key and text alone, joined by the key alone: the texts are shuffled once.
    placed = rows.select("key", "text").join(order, "key")
    stands = F.xxhash64("text").bitwiseXOR(F.col("stands")) == 0
    lent = (placed.filter(stands).select("borrower", F.expr("substring(text, 1, lent)").alias("part"))
            .groupBy("borrower").agg(F.first("part").alias("part")))
    both = placed.drop("borrower").join(lent, F.col("key") == F.col("borrower"))
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 2)))"),
                      F.expr("substring(part, 1, int(floor(length(text) / 2)))"))
    both = both.select("key", "next_key", stands.alias("stands"), n.cast("long").alias("n_chars"), "text",
                       edited.alias("edited")).withColumn("row", F.monotonically_increasing_id())
    two = both.select("key", "next_key", "stands", "n_chars", "row",
                      F.sha2("edited", 256).alias("edited_sha256"),
                      F.inline(F.array(F.struct(F.lit(0).alias("which"), F.col("text")),
                                       F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))))
    names = ["key", "next_key", "stands", "n_chars", "row", "edited_sha256"]
    prints = fingerprints(two, [*names, "which"])
    wide = prints.groupBy(*names).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
                                      F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited"))
    wide = staging.table(wide, "prints")
    nexts = wide.filter("stands").groupBy(F.col("key").alias("that")).agg(F.first("fingerprint").alias("next_print"))
    like = lambda a, b: (F.lit(64) - distance(F.col(a), F.col(b))) / F.lit(64.0)
    return wide.join(nexts, F.col("next_key") == F.col("that")).select(
        F.col("key").try_cast("bigint").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited",
        like("fingerprint", "edited").alias("near_edited"),
        like("fingerprint", "next_print").alias("near_next"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison, and the search: for every 50th id how many other documents lie within the radius, and which.

    Documents of one fingerprint are a class, named by its least id; the found
    ones are listed by their classes, so copies are not listed one by one.
    """
    staging = Staging(spark)
    rows = staging.table(compare(spark, documents(spark, folder), staging), "compared")
    held = staging.table(rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("class_id")), "classes")
    asked = rows.filter(F.col("doc_id") % QUERY_EVERY == 0).select("fingerprint").distinct()
    near = neighbours(asked, held.select("fingerprint")).join(held, "fingerprint").groupBy("query_print").agg(
        F.sum("n").alias("within"), F.sort_array(F.collect_set("class_id")).alias("classes"))
    told = held.join(near, held["fingerprint"] == near["query_print"], "left").select(
        F.col("fingerprint").alias("print"), "class_id", "within", "classes")
    found = rows.join(told, F.col("fingerprint") == F.col("print"))
    asks = F.col("doc_id") % QUERY_EVERY == 0
    return found.select("doc_id", "n_chars", "edited_sha256", text_form(F.col("fingerprint")).alias("fingerprint"),
                        text_form(F.col("edited")).alias("edited_fingerprint"), "near_edited", "near_next",
                        F.when(asks, F.col("within") - 1).alias("n_within"), "class_id", F.when(asks, F.col("classes")).alias("near_classes"))

"""Phrases whose words belong together, by best-first branch-and-bound growth.

Phrases are grown from their first word. The count of a prefix bounds the score of
everything that grows from it: no phrase occurs more often than its rest, so a cut
after the first word gives at most 1000 n / f(first word). First words are expanded
in order of that bound, rarest first, until the 2000th surviving score of each
language, ties included, lies above the bound of all words that are left.

Counting works on hashes of words and phrases, computed over whole byte blocks; the
sets of words and phrases that are to be grown travel as bitmaps of one fixed size,
whose false positives cost time only. What is kept is counted once more by its text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.bitmap import Bitmap
from cleartab.llm.common import keep_only, whole_text
from cleartab.llm.hashes import ODD, powers
from cleartab.session import Staging

LONGEST, LEAST, TOP, SCALE = 5, 100, 2000, 1000
SHARES = (0.25, 1.0)
"""Words expanded by the end of each turn: the rarest, that together make this share of all frequent occurrences."""
BLOCK = 4 << 20
"""Bytes tokenized together."""

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2
_MORE = 0xD6E8FEB86659FD93


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MORE)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MORE)
    return x ^ (x >> np.uint64(32))


class Words:
    """Words of a block of text in one language: places, pieces and hashes.

    A hash is the sum of byte times power of its place, taken back to the start of
    the word, so all words are hashed in one pass over the bytes.
    """

    def __init__(self, lang: str, text: bytes):
        self.lang, self.text = lang, text.translate(_LOWER)
        raw = np.frombuffer(self.text, np.uint8)
        kind = _KIND[raw]
        word = (kind == 0).view(np.int8)
        edge = np.diff(word, prepend=np.int8(0), append=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        if len(self.starts):
            up, down = powers(len(raw))
            sums = np.add.reduceat(np.where(word, raw, 0).astype(np.uint64) * up, self.starts)
            length = (self.ends - self.starts).astype(np.uint64)
            self.hash = _mix(sums * down[self.starts] + length * np.uint64(_MORE))
        else:
            self.hash = np.empty(0, np.uint64)
        salt = int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self.keys = [_mix(self.hash ^ np.uint64(salt))]
        for k in range(1, LONGEST):
            last = self.keys[-1]
            n = max(0, len(self.hash) - k)
            self.keys.append(_mix(last[:n] * np.uint64(ODD) + self.hash[k:]))

    def whole(self, at: np.ndarray, k: int) -> np.ndarray:
        """Of the given places, those where k words follow within the piece."""
        at = at[at + k <= len(self.piece)]
        return at[self.piece[at] == self.piece[at + k - 1]]

    def phrase(self, at: int, k: int) -> bytes:
        return b" ".join(self.text[s:e] for s, e in zip(self.starts[at:at + k], self.ends[at:at + k]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Texts of a language put together, cut only where a piece ends."""
    held, size = {}, 0
    def emptied():
        for lang, texts in held.items():
            rest = b"\n".join(texts)
            while len(rest) > BLOCK and (cut := _BREAK.search(rest, BLOCK)):
                yield Words(lang, rest[:cut.start()])
                rest = rest[cut.start():]
            yield Words(lang, rest)
        held.clear()
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size >= BLOCK:
                yield from emptied()
                size = 0
    yield from emptied()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, and where each distinct one begins in it, with its count."""
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(keys)))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _texts(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for w in _blocks(batches):
        keys = w.keys[0]
        order, first, n = _distinct(keys)
        at = order[first]
        texts = [w.text[s:e] for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist())]
        yield pa.record_batch([pa.array([w.lang] * len(at), pa.string()), _texts(texts), _long(keys[at]), pa.array(n)],
                              ["lang", "word", "key", "n"])


def pair_counts(first_words, frequent) -> Callable:
    """Counts of pairs of frequent words that begin with a word of this turn, by key."""
    def run(batches):
        for w in _blocks(batches):
            at = w.whole(np.flatnonzero(first_words.value.has(w.keys[0])), 2)
            at = at[frequent.value.has(w.keys[0][at + 1])]
            keys = w.keys[1][at]
            order, first, n = _distinct(keys)
            yield pa.record_batch([_long(keys[order[first]]), pa.array(n)], ["key", "n"])
    return run


def growth_counts(pairs, counted_words, counted_pairs, frequent) -> Callable:
    """Counts of phrases of three and more words that grow from the pairs of this turn, with the keys of their rests.

    Inside, a pair whose first word has been expanded must be frequent as well.
    """
    def run(batches):
        for w in _blocks(batches):
            two = np.arange(max(0, len(w.hash) - 1))
            known = counted_words.value.has(w.keys[0][:-1]) if len(w.hash) else np.empty(0, bool)
            goes_on = frequent.value.has(w.keys[0][1:]) & (~known | counted_pairs.value.has(w.keys[1]))
            at = w.whole(two, 2)
            at = at[pairs.value.has(w.keys[1][at])]
            for k in range(3, LONGEST + 1):
                at = w.whole(at, k)
                at = at[goes_on[at + k - 2]]
                keys = w.keys[k - 1][at]
                order, first, n = _distinct(keys)
                places = at[order[first]]
                rests = [_long(w.keys[k - 1 - j][places + j]) if k - j > 1 else pa.nulls(len(places), pa.int64())
                         for j in range(1, LONGEST - 1)]
                yield pa.record_batch([_long(keys[order[first]]), pa.array(n), *rests],
                                      ["key", "n", *(f"rest{j}" for j in range(1, LONGEST - 1))])
    return run


PHRASES = "lang string, phrase string, n long, key long, before_low long, before_high long, after_low long, after_high long"


def phrase_counts(wanted, frequent) -> Callable:
    """Exact counts of the wanted phrases by text, and whether one word stands before or after all of them.

    The words around are told by the least and greatest of their keys; 0 stands for the edge of a piece.
    """
    def run(batches):
        for w in _blocks(batches):
            n = len(w.hash)
            often = np.flatnonzero(frequent.value.has(w.keys[0]))
            same = np.zeros(n + 1, bool)
            same[1:n] = w.piece[1:] == w.piece[:-1]
            before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
            around = (w.keys[0] | np.uint64(1)).view(np.int64)
            before[1:] = np.where(same[1:n], around[:-1], 0)
            after[:-1] = np.where(same[1:n], around[1:], 0)
            for k in range(2, LONGEST + 1):
                at = w.whole(often, k)
                at = at[wanted.value.has(w.keys[k - 1][at])]
                keys = w.keys[k - 1][at]
                order, first, count = _distinct(keys)
                if not len(first):
                    continue
                at = at[order]
                places = at[first]
                edge = lambda f, side, shift: pa.array(f.reduceat(side[at + shift], first))
                yield pa.record_batch([
                    pa.array([w.lang] * len(places), pa.string()), _texts([w.phrase(i, k) for i in places.tolist()]),
                    pa.array(count), _long(keys[order[first]]), edge(np.minimum, before, 0), edge(np.maximum, before, 0),
                    edge(np.minimum, after, k - 1), edge(np.maximum, after, k - 1)],
                    ["lang", "phrase", "n", "key", "before_low", "before_high", "after_low", "after_high"])
    return run


def expansion(words: DataFrame) -> DataFrame:
    """(lang, n, turn): the turn in which a word that occurs n times is expanded, and the least n of the next turn.

    Rows are one for each language and count, far fewer than words.
    """
    levels = words.groupBy("lang", "n").agg(F.sum("n").alias("mass"))
    rising = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("mass").over(rising), F.lit(0)) / F.sum("mass").over(Window.partitionBy("lang"))
    turn = F.size(F.filter(F.array(*[F.lit(s) for s in SHARES]), lambda s: s <= share)).cast("int")
    return levels.select("lang", "n", turn.alias("turn"))


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase, whole-number arithmetic of up to 38 digits."""
    parts = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", "n", "held", F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
                             "right": F.array_join(F.slice(parts, F.col("k") + 1, F.size(parts)), " ")})
    known = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    other = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(known, ["lang", "left"]).join(other, ["lang", "right"]).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumns({"up": F.lit(SCALE).cast("decimal(38,0)") * big("n") * big("total"), "down": big("l") * big("r")})
    cuts = cuts.withColumn("score", F.expr("up div down"))
    low = F.min(F.struct("score", "k", "l", "r", "total"))
    return cuts.groupBy("lang", "phrase").agg(F.first("n").alias("a"), F.first("held").alias("held"), low.alias("low")).select(
        "lang", "phrase", "a", "held", "low.l", "low.r", F.col("low.total").alias("n"), "low.score")


def mine(docs: DataFrame, staging: Staging) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first TOP phrases of each language.

    A null text is empty, a null language is ``und``; repeated rows count each
    time; documents without words, or an empty table, give nothing; languages
    with fewer phrases give all they have; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = keep_only(docs, "text", "lang").select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text(docs).alias("text"))
    share = spark.sparkContext.broadcast
    counted = staging.table(
        texts.mapInArrow(word_counts, "lang string, word string, key long, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("key").alias("key")), "words")
    totals = staging.table(counted.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    often = counted.filter(F.col("n") >= LEAST)
    words = staging.table(often.join(expansion(often), ["lang", "n"]), "frequent")
    frequent = share(Bitmap.of(words))
    open_langs, counts, done, pair_keys = totals.select("lang"), words.select("lang", F.col("word").alias("phrase"), "n"), None, None
    for turn in range(len(SHARES)):
        first = words.filter(F.col("turn") == turn).join(open_langs, "lang", "left_semi")
        sums = lambda df: df.groupBy("key").agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in df.columns[2:]]).filter(F.col("n") >= LEAST)  # noqa: E731,E501
        pairs = staging.table(sums(texts.mapInArrow(pair_counts(share(Bitmap.of(first)), frequent), "key long, n long")), f"pairs_{turn}")
        pair_keys = pairs.select("key") if pair_keys is None else pair_keys.unionByName(pairs.select("key"))
        grow = growth_counts(share(Bitmap.of(pairs)), share(Bitmap.of(words.filter(F.col("turn") <= turn))),
                             share(Bitmap.of(pair_keys)), frequent)
        rests = ", ".join(f"rest{j} long" for j in range(1, LONGEST - 1))
        longer = staging.table(sums(texts.mapInArrow(grow, f"key long, n long, {rests}")), f"longer_{turn}")
        keys = longer.select(F.explode(F.array("key", *[f"rest{j}" for j in range(1, LONGEST - 1)])).alias("key"))
        keys = keys.filter("key is not null").unionByName(pairs.select("key"))
        exact = staging.table(
            texts.mapInArrow(phrase_counts(share(Bitmap.of(keys)), frequent), PHRASES).groupBy("lang", "phrase")
            .agg(F.sum("n").alias("n"), F.min("before_low").alias("before_low"), F.max("before_high").alias("before_high"),
                 F.min("after_low").alias("after_low"), F.max("after_high").alias("after_high"))
            .filter(F.col("n") >= LEAST), f"exact_{turn}")
        alike = lambda side: (F.col(f"{side}_low") == F.col(f"{side}_high")) & (F.col(f"{side}_low") != 0)
        held = (F.size(F.split("phrase", " ")) < LONGEST) & (alike("before") | alike("after"))
        counts = counts.unionByName(exact.select("lang", "phrase", "n")).distinct()
        grown = exact.withColumns({"held": held, "word": F.substring_index("phrase", " ", 1)}).join(
            first.select("lang", "word"), ["lang", "word"], "left_semi")
        scores = staging.table(scored(grown, counts, totals), f"scored_{turn}")
        done = scores if done is None else done.unionByName(scores)
        # A language is settled when TOP survivors score above everything that is left.
        left = words.filter(F.col("turn") > turn).groupBy("lang").agg(F.min("n").alias("next"))
        if turn == len(SHARES) - 1:
            break
        bound = F.expr(f"cast({SCALE} * cast(total as decimal(38,0)) div next as bigint)")
        ahead = (done.filter(~F.col("held")).join(left.join(totals, "lang").select("lang", bound.alias("bound")), "lang")
                 .groupBy("lang").agg(F.count_if(F.col("score") > F.col("bound")).alias("ahead")))
        open_langs = staging.table(open_langs.join(left, "lang", "left_semi").join(
            ahead.filter(F.col("ahead") >= TOP), "lang", "left_anti"), f"open_{turn}")
        if open_langs.isEmpty():
            break
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (done.filter(~F.col("held")).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return mine(spark.read.parquet(f"{folder}/documents.parquet"), Staging(spark))

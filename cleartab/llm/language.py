"""Language identification with a word-first backoff model."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.common import documents, keep_only, words
from cleartab.session import Staging

SAMPLE_DOCUMENTS = 5_000
"""Expected bound, for each language, of the labelled sample that the model is fitted on."""
VOCABULARY = 15_000
GRAMS = 10_000
"""Words, and n-grams of each length, that each language brings into the model: its commonest ones."""
LONGEST = 4
"""Character n-grams go from this length down to single characters."""
UNKNOWN = "und"
LEAST_SCORE = 0.5
LEAST_KNOWN = 0.2
"""Share of a text's words that must be words of the model; the score alone tells languages apart, not language from noise."""
REMEMBERED = 200_000
"""Words outside the model whose rows a task keeps."""

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def held_out(doc_id) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _normal(text) -> Column:
    """Lower case, everything but letters and marks as blanks."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")


def _top(counts: DataFrame, name: str, most: int) -> list[tuple[str, dict[str, int]]]:
    """The ``most`` commonest entries of every language, ties by name, with their count in each language."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), name))
    rows = (counts.withColumn("place", place).groupBy(name).agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.min("place").alias("place"))
        .filter(F.col("place") <= most).orderBy(name).collect())
    return [(r[name], r["by"]) for r in rows]


def fit(docs: DataFrame, staging: Staging) -> dict:
    """Log frequencies of words and character n-grams per language.

    Only labelled rows whose checksum does not hold them out are used, of each
    language a sample by hash of about ``SAMPLE_DOCUMENTS``, so a rare one loses
    nothing to a common one. Counting is done by Spark; the driver gets at most
    ``VOCABULARY`` words and ``GRAMS`` n-grams per length for each language.
    """
    rows = keep_only(docs, "doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    draw = F.crc32(F.concat(F.lit("fit/"), F.col("doc_id").cast("string")).cast("binary"))
    chosen = F.lit(True)
    for lang, total in sorted(totals.items()):
        if total > SAMPLE_DOCUMENTS:
            chosen &= (F.col("lang") != lang) | (draw < int(SAMPLE_DOCUMENTS / total * 2 ** 32))
    rows = rows.filter(chosen)
    counts = staging.table(rows.select("lang", F.explode(words(_normal(F.col("text")))).alias("word"))
                           .groupBy("lang", "word").agg(F.count("*").alias("n")), "word_counts")
    known, grams = _top(counts, "word", VOCABULARY), []
    for size in range(1, LONGEST + 1):
        padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
        starts = F.sequence(F.lit(1), F.length(padded) - (size - 1))
        each = counts.filter(F.length("word") >= size - 2).select("lang", "n", F.explode(F.transform(
            starts, lambda i: F.substring(padded, i, F.lit(size)))).alias("gram"))  # noqa: B023
        grams.append(_top(each.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram", GRAMS))
    languages = sorted({lang for _, by in known for lang in by})

    def logs(table):
        """Add-half smoothed log frequency of each entry in each language."""
        if not table:
            return {}
        n = np.array([[by.get(lang, 0) for lang in languages] for _, by in table], dtype=float) + 0.5
        return dict(zip([k for k, _ in table], np.log(n / n.sum(axis=0)).astype(np.float32)))

    return {"languages": languages, "words": logs(known), "grams": [logs(g) for g in grams]}


def scorer(model: dict):
    """A function from text to (language, score, share of known words).

    Words are numbers of rows of one table; those of the model come first. Words that
    it lacks, and the words of every token between blanks, are remembered up to ``REMEMBERED``.
    """
    import regex

    languages, known = model["languages"], list(model["words"])
    letters, width = regex.compile(r"[^\p{L}\p{M}]+"), len(languages)

    def rows(parts: dict) -> np.ndarray:
        return np.array(list(parts.values()), dtype=np.float32).reshape(len(parts), width)

    grams, values = [], [np.zeros((1, width), dtype=np.float32)]  # row 0 adds nothing
    for each in model["grams"]:
        start = sum(map(len, values))
        grams.append({gram: start + i for i, gram in enumerate(each)})
        values.append(rows(each))
    values = np.concatenate(values)
    table = rows(model["words"])
    numbers, tokens = {}, {}
    has_letter = [any(map(str.isalpha, word)) for word in known]

    def backed_off(words: list[str]) -> np.ndarray:
        """Of each word the mean over its n-grams of the longest length of which any is known."""
        found = []
        for word in words:
            padded = f" {word} "
            for size in range(min(len(grams), len(padded)), 0, -1):
                get = grams[size - 1].get
                if some := [v for i in range(len(padded) - size + 1) if (v := get(padded[i:i + size]))]:
                    break
            else:
                some = []
            found.append(some)
        out = np.empty((len(words), width), dtype=np.float32)
        lengths = np.array([len(some) for some in found])
        order = np.argsort(lengths, kind="stable")
        for part in np.array_split(order, -(-len(order) // 64)):  # words of like length together
            most = max(1, int(lengths[part[-1]]))
            at = np.zeros((len(part), most), dtype=np.int64)
            for k, i in enumerate(part.tolist()):
                at[k, :lengths[i]] = found[i]
            total = np.zeros((len(part), width), dtype=np.float32)
            for column in at.T:
                total += values[column]
            out[part] = total / np.maximum(lengths[part], 1)[:, None]
        return out

    def words_of(token: str) -> tuple[int, ...]:
        out = []
        for word in (token,) if token.isascii() and token.isalpha() else letters.sub(" ", token).split():
            number = numbers.get(word)
            if number is None:
                number = numbers[word] = len(has_letter)
                has_letter.append(any(map(str.isalpha, word)))
                new.append(word)
            out.append(number)
        tokens[token] = out = tuple(out)
        return out

    new: list[str] = []
    used = 0

    def forget() -> None:
        nonlocal used
        numbers.clear()
        tokens.clear()
        numbers.update(zip(known, range(len(known))))
        del has_letter[len(known):]
        used = len(known)

    def learn() -> None:
        """Rows of the new words at the end of the table, which doubles when it is full."""
        nonlocal table, used
        if used + len(new) > len(table):
            table = np.concatenate([table[:used], np.empty((used + len(new) + 1_000, width), dtype=np.float32)])
        table[used:used + len(new)] = backed_off(new)
        used += len(new)
        new.clear()

    forget()

    def score(text: str | None) -> tuple[str, float, float]:
        if not text or not languages:
            return UNKNOWN, 0.0, 0.0
        if len(numbers) >= len(known) + REMEMBERED or len(tokens) >= 2 * REMEMBERED:
            forget()
        counts: dict[int, int] = {}
        for token, times in Counter(text.lower().split()).items():
            found = tokens.get(token)
            for number in words_of(token) if found is None else found:
                counts[number] = counts.get(number, 0) + times
        if new:
            learn()
        if not any(has_letter[number] for number in counts):
            return UNKNOWN, 0.0, 0.0
        at = np.fromiter(counts, dtype=np.int64, count=len(counts))
        n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        total = n @ table[at].astype(np.float64)
        best = int(total.argmax())  # of equal ones the first by name
        spread = np.exp(np.maximum(total - total[best], -700.0))
        return languages[best], float(1.0 / spread.sum()), float(n[at < len(known)].sum() / n.sum())

    return score


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text.

    ``und`` with score 0 for a null text, one without letters, and when nothing
    was learned. The score is the probability of the language under equal
    priors. Ties go to the first language by name. Repeated rows are scored one
    by one, an empty table gives no rows, a null id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        score = scorer(shared.value)
        for batch in batches:
            found = [score(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = keep_only(docs, "doc_id", "text").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def accepted(docs: DataFrame, model: dict, least: float = LEAST_SCORE) -> DataFrame:
    """The rows, all columns kept, whose language is recognised with at least this score, and of whose words at least
    ``LEAST_KNOWN`` are known; no shuffle."""
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches):
        import pyarrow as pa

        score = scorer(shared.value)
        for batch in batches:
            texts = batch.column(names.index("text"))
            found = [score(text.as_py()) for text in texts]
            yield batch.filter(pa.array([lang != UNKNOWN and s >= least and k >= LEAST_KNOWN for lang, s, k in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return predict(docs, fit(docs, Staging(spark)))

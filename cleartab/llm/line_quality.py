"""Quality by labelling lines: a linear-chain conditional random field tells content from boilerplate.

Each line is described by a few shares and counts. The field scores a label for
each line and for each pair of neighbouring labels; Viterbi decoding finds the
best sequence, and the share of a text's word characters that lie in content
lines decides whether it is kept.

Labels are given for documents only. Those of lines are learnt from them: a first
field without pairs says how a line looks that stands in good or in bad documents;
where it contradicts a document's label clearly, the line gets the other one. The
field proper is fitted on pieces of documents and on compositions of pieces of both
kinds, in which labels change from one line to the next.
"""

from __future__ import annotations

import operator
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.llm.common import documents, keep_only

SAMPLE_DOCUMENTS = 2_000
"""Expected bound of the labelled sample that the field is fitted on."""
PIECE_LINES, PIECES = 64, 8
"""A text of the sample gives up to PIECES pieces of up to PIECE_LINES lines, spread over all of it."""
TRUST = 2.0
"""Log odds by which the label of a document speaks for each of its lines."""
LEAST_SHARE = 0.5
STEPS = 150

# What the contract counts as blank and as symbol.
BLANK = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_HIGH = bytes(range(128, 256))
FEATURES = 12
_SYMBOL_BYTES = SYMBOLS.encode()
SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double")


def repeated_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts, n, upto = Counter(grams), 0, 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            n += i + 3 - max(i, upto)
            upto = i + 3
    return n


def line_features(line: str, repeated: bool) -> tuple[list[float], int]:
    """Features of a line, all about 0 to 1, and its number of word characters."""
    data = line.encode()
    words = data.split()
    chars = len(line) - sum(map(line.count, BLANK))
    if not words:
        return [1.0] + [0.0] * (FEATURES - 1), 0
    size, n = len(data), len(words)
    upper, lower = size - len(data.translate(None, _UPPER)), size - len(data.translate(None, _LOWER))
    high = size - len(data.translate(None, _HIGH))
    symbols = sum(map(line.count, SYMBOLS))
    return [
        1.0,
        upper / (upper + lower + 1),
        min(symbols / n, 3.0) / 3,
        min(line.count("!") / n, 2.0) / 2,
        (size - len(data.translate(None, _DIGITS))) / size,
        high / size,
        min(float(np.log1p(n)), 6.0) / 6,
        min(chars / n, 20.0) / 20,
        sum(map(operator.eq, words, words[1:])) / n,
        float(repeated),
        float(line.rstrip(BLANK)[-1:] in ".!?"),
        sum(not w.strip(_SYMBOL_BYTES) for w in words) / n if symbols else 0.0,
    ], chars


def described(text: str) -> tuple[list[list[float]], list[int], int]:
    """Features and word characters of each line with a word, and how many of these repeat an earlier one."""
    seen, rows, chars, again = set(), [], [], 0
    for line in text.split("\n"):
        if not line.strip(BLANK):
            continue
        repeated = line in seen
        seen.add(line)
        again += repeated
        row, n = line_features(line, repeated)
        rows.append(row)
        chars.append(n)
    return rows, chars, again


def fitted(sequences: list[np.ndarray], labels: list[np.ndarray], steps: int = STEPS, chained: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (of content against boilerplate) and label-pair weights of most likelihood.

    Full-batch gradient ascent with a small quadratic penalty; expectations by
    forward and backward passes over all sequences of about one length at once.
    Without ``chained`` the pair weights stay 0.
    """
    batches = []
    by_length: dict[int, list[int]] = {}
    for i, rows in enumerate(sequences):
        by_length.setdefault(len(rows).bit_length(), []).append(i)
    for at in by_length.values():
        longest = max(len(sequences[i]) for i in at)
        x, y = np.zeros((len(at), longest, FEATURES)), np.zeros((len(at), longest))
        mask = np.zeros((len(at), longest), dtype=bool)
        for k, i in enumerate(at):
            n = len(sequences[i])
            x[k, :n], y[k, :n], mask[k, :n] = sequences[i], labels[i], True
        batches.append((x, y, mask))
    seen_pairs = np.zeros((2, 2))
    for _, y, mask in batches:
        for a in (0, 1):
            for b in (0, 1):
                seen_pairs[a, b] += (mask[:, 1:] & (y[:, :-1] == a) & (y[:, 1:] == b)).sum()
    weights, pairs = np.zeros(FEATURES), np.zeros((2, 2))
    moments = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)), np.zeros((2, 2))]
    total = sum(mask.sum() for _, _, mask in batches)
    for step in range(1, steps + 1):
        gradient, expected = -1e-3 * weights, np.zeros((2, 2))
        for x, y, mask in batches:
            g, e = _expectations(x, y, mask, weights, pairs)
            gradient, expected = gradient + g / total, expected + e
        pair_gradient = (seen_pairs - expected) / total - 1e-3 * pairs if chained else np.zeros((2, 2))
        for value, g, m, v in ((weights, gradient, moments[0], moments[1]), (pairs, pair_gradient, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return weights, pairs


def _expectations(x, y, mask, weights, pairs) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the emission weights, and the label pairs that the field expects."""
    longest, both = x.shape[1], mask[:, 1:]
    emit = np.zeros((len(x), longest, 2))
    emit[:, :, 1] = x @ weights
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for t in range(1, longest):
        moved = np.logaddexp(forward[:, t - 1, :1] + pairs[0], forward[:, t - 1, 1:] + pairs[1]) + emit[:, t]
        forward[:, t] = np.where(mask[:, t, None], moved, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        after = emit[:, t + 1] + backward[:, t + 1]
        moved = np.logaddexp(after[:, :1] + pairs[:, 0], after[:, 1:] + pairs[:, 1])
        backward[:, t] = np.where(mask[:, t + 1, None], moved, backward[:, t + 1])
    norm = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    content = np.exp(forward[:, :, 1] + backward[:, :, 1] - norm[:, None]) * mask
    expected = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair = forward[:, :-1, a] + pairs[a, b] + emit[:, 1:, b] + backward[:, 1:, b] - norm[:, None]
            expected[a, b] = np.exp(np.where(both, pair, -np.inf)).sum()
    return (((y * mask) - content)[:, :, None] * x).sum(axis=(0, 1)), expected


def line_labels(sequences: list[np.ndarray], kinds: list[int]) -> list[np.ndarray]:
    """A label for each line: its document's, unless the line clearly looks like those of the other kind.

    The first field weighs both kinds of lines alike, whatever their numbers.
    """
    weights, _ = fitted(sequences, [np.full(len(s), k) for s, k in zip(sequences, kinds)], chained=False)
    return [(s @ weights + TRUST * (2 * k - 1) > 0).astype(int) for s, k in zip(sequences, kinds)]


def composed(sequences: list[np.ndarray], labels: list[np.ndarray], kinds: list[int], seed: int = 1) -> tuple[list, list]:
    """The sequences, and as many again in which stretches of both kinds follow each other."""
    draw = np.random.default_rng(seed)
    sides = [[i for i, k in enumerate(kinds) if k == kind] for kind in (0, 1)]
    more, told = [], []
    for _ in range(len(sequences)):
        parts, side = [], int(draw.integers(2))
        for _ in range(int(draw.integers(2, 4))):
            i = sides[side][draw.integers(len(sides[side]))]
            low = int(draw.integers(len(sequences[i])))
            parts.append((i, low, int(draw.integers(low + 1, len(sequences[i]) + 1))))
            side = 1 - side
        more.append(np.concatenate([sequences[i][low:high] for i, low, high in parts]))
        told.append(np.concatenate([labels[i][low:high] for i, low, high in parts]))
    return sequences + more, labels + told


def learnt(sequences: list[np.ndarray], kinds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The field, from pieces of documents and the labels of these."""
    return fitted(*composed(sequences, line_labels(sequences, kinds), kinds))


def pieces(rows: list[list[float]]) -> list[list[list[float]]]:
    """Up to PIECES runs of up to PIECE_LINES lines, evenly spread."""
    starts = range(0, len(rows), PIECE_LINES)
    if len(starts) > PIECES:
        starts = [int(i * (len(rows) - PIECE_LINES) / (PIECES - 1)) for i in range(PIECES)]
    return [rows[i:i + PIECE_LINES] for i in starts]


def decoded(rows: np.ndarray, weights: np.ndarray, pairs: np.ndarray) -> list[int]:
    """The best label sequence, 1 for content; ties go to content."""
    emit = (rows @ weights).tolist()
    (p00, p01), (p10, p11) = pairs.tolist()
    zero, one, back = 0.0, emit[0], []
    for e in emit[1:]:
        from_zero, from_one = zero + p00, one + p10
        to_zero, to_one = zero + p01, one + p11
        back.append((int(from_one >= from_zero), int(to_one >= to_zero)))
        zero, one = max(from_zero, from_one), max(to_zero, to_one) + e
    label = int(one >= zero)
    out = [label]
    for choice in reversed(back):
        label = choice[label]
        out.append(label)
    return out[::-1]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The field, from a sample by hash of labelled documents, texts of any length.

    Null labels and texts are left out; several labels of one document count as
    the best of them. None where one of the two labels is missing.
    """
    marked = keep_only(labels, "doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total = marked.count()
    if not total:
        return None
    cut = int(min(1.0, SAMPLE_DOCUMENTS / total) * 2 ** 32)
    chosen = marked.filter(F.crc32(F.concat(F.lit("fit/"), F.col("doc_id").cast("string")).cast("binary")) < cut)
    texts = keep_only(docs, "doc_id", "text").filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [(i, q, np.ravel(piece).tolist()) for i, text, q in zip(*[batch.column(k).to_pylist() for k in range(3)])
                     for piece in pieces(described(text)[0])]
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.list_(pa.float64()))], ["doc_id", "quality", "rows"])

    # The sample is bounded by SAMPLE_DOCUMENTS, PIECES and PIECE_LINES, whatever the size of the tables.
    found = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("long"))
             .mapInArrow(run, "doc_id bigint, quality bigint, rows array<double>").orderBy("doc_id", "rows").collect())
    sequences = [np.reshape(r["rows"], (-1, FEATURES)) for r in found]
    kinds = [int(r["quality"] > 0) for r in found]
    return learnt(sequences, kinds) if len(set(kinds)) == 2 else None


def judge(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """Counts and verdict of every row, see ``SCHEMA``, from its whole text.

    A null text is empty and fails; so does one without words. Without a model
    every line is content. Repeated rows are judged one by one; an empty table
    gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: str) -> tuple:
        words = text.encode().split()
        rows, chars, again = described(text)
        total, repeats = sum(chars), repeated_words(words)
        failed = len(words) < 50 or 100 * repeats > 50 * len(words)
        if not rows or shared.value is None:
            share = float(bool(rows))
        else:
            share = sum(c for c, label in zip(chars, decoded(np.array(rows), *shared.value)) if label) / total
        return (len(words), total, sum(map(text.count, SYMBOLS)), again, repeats, failed,
                not failed and share >= LEAST_SHARE, share)

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64()]
        for batch in batches:
            rows = [one(text.as_py() or "") for text in batch.column(1)]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    return keep_only(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return judge(docs, fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))

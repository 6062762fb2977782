"""Hard negatives by threshold joins over an inverted index that leaves out what norms already cover.

Anchors are a stated query set; they meet all rows in blocks. Inside a block, rows
are indexed strip by strip (a few dimensions each). The leading strips of a row are
left out as long as their norm times the anchor's cannot reach the threshold. Partial
scores are summed up from the last strip to the first, rows are dropped as soon as
the norms that remain cannot lift any anchor to its threshold, and what is left is
scored exactly. Thresholds start high and are lowered until every window is full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.common import keep_only
from cleartab.session import Staging

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH, WHOLE = 80, 100, 100
"""A negative scores between LOW / WHOLE and HIGH / WHOLE of its positive."""
ROWS, ANCHORS, TOGETHER, PAIRS = 4096, 4096, 64, 1 << 15
"""Rows and anchors of a block, anchors searched and pairs scored together; they bound the memory of a task."""
STRIP = 16
SHARES = (0.7, 0.5, 0.35, 0.2)
"""Thresholds for positives, as shares of the largest product of norms in a block; after the last, none."""
STEPS = (95, 90, 85, LOW)
"""Thresholds for negatives in hundredths of the positive's score."""


class StripIndex:
    """Rows of a block by strips of dimensions; ``x`` has whole numbers."""

    def __init__(self, x: np.ndarray):
        wide = -(-max(x.shape[1], 1) // STRIP) * STRIP
        self.x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
        self.exact = self.x.astype(np.float64)
        self.strips = wide // STRIP
        self.before = prefix_norms(self.exact, self.strips)

    def lists(self, least: float) -> list[np.ndarray]:
        """Posting list of each strip: the rows whose norm up to its end reaches ``least``."""
        return [np.flatnonzero(self.before[:, s + 1] >= least) for s in range(self.strips)]

    def search(self, a: np.ndarray, threshold: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All (anchor, row, score) with a score at or above the anchor's threshold, some anchors at a time."""
        a = np.pad(a, ((0, 0), (0, self.x.shape[1] - a.shape[1])))
        for i in range(0, len(a), TOGETHER):
            yield self._together(a[i:i + TOGETHER], threshold[i:i + TOGETHER], i)

    def _together(self, a, threshold, first):
        exact = a.astype(np.float64)
        norms = prefix_norms(exact, self.strips)
        slack = threshold - 1e-9 * np.abs(threshold) - 0.01
        whole = np.maximum(norms[:, -1], 1e-300)
        lists = self.lists(float((slack / whole).min()))
        partial = np.zeros((len(a), len(self.x)))
        live = np.ones(len(self.x), bool)
        for s in reversed(range(self.strips)):
            rows = lists[s][live[lists[s]]]
            part = slice(s * STRIP, (s + 1) * STRIP)
            if len(rows) == len(self.x):
                partial += exact[:, part] @ self.exact[:, part].T
            else:
                partial[:, rows] += exact[:, part] @ self.exact[rows, part].T
            if s:
                # By row: the norms that remain lift no anchor to its threshold.
                needed = slack[:, None] - (partial if len(rows) == len(self.x) else partial[:, rows])
                live[rows] = (needed <= np.multiply.outer(norms[:, s], self.before[rows, s])).any(0)
        # Rows in no list are out, and so are rows that were dropped on the way.
        live &= self.before[:, -1] >= (slack / whole).min()
        rows = np.flatnonzero(live)
        # What lists left out of a row is bounded by its norm up to the first strip that has the row.
        out = np.zeros(len(self.x), int)
        for s in range(self.strips):
            out[self.before[:, s + 1] < (slack / whole).min()] = s + 1
        rest = norms[:, out[rows]] * self.before[rows, out[rows]][None, :]
        i, j = np.nonzero(partial[:, rows] + rest >= slack[:, None])
        j = rows[j]
        score = np.concatenate([np.empty(0, np.int64)] + [
            np.einsum("ij,ij->i", a[i[k:k + PAIRS]], self.x[j[k:k + PAIRS]]) for k in range(0, len(i), PAIRS)])
        keep = score >= threshold[i]
        return i[keep] + first, j[keep], score[keep]


def prefix_norms(x: np.ndarray, strips: int) -> np.ndarray:
    """Norm of each row up to the end of each strip; the first column is 0."""
    squares = np.cumsum((x * x).reshape(len(x), strips, STRIP).sum(2), 1)
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), squares], 1))


def _matrix(column: pa.ChunkedArray, wide: int) -> np.ndarray:
    """Vectors as rows; missing components count as 0."""
    arrays = column.combine_chunks()
    lengths = np.diff(arrays.offsets.to_numpy())
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.arange(wide)[None, :] < lengths[:, None]] = arrays.flatten().to_numpy()
    return out


def _pair(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    wide = max([1] + [n for t in (rows, anchors) for n in pa.compute.list_value_length(t["vec"]).to_pylist()])
    wide = -(-wide // STRIP) * STRIP
    return _matrix(rows["vec"], wide), _matrix(anchors["vec"], wide)


def _best(group: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The first n of each group by score, then id."""
    order = np.lexsort((ids[row], -score, group))
    group, row, score = group[order], row[order], score[order]
    first = np.searchsorted(group, group)
    keep = np.arange(len(group)) - first < n
    return group[keep], row[keep], score[keep]


def block_positives(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Within a block, the first POSITIVES other rows of each anchor's label: (anchor, row, score) positions."""
    x, a = _pair(rows, anchors)
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    anchor_ids, anchor_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    for label in np.unique(anchor_labels):
        mine = np.flatnonzero(labels == label)
        todo = np.flatnonzero(anchor_labels == label)
        if not len(mine):
            continue
        index = StripIndex(x[mine])
        largest = index.before[:, -1].max()
        norms = np.sqrt((a[todo].astype(np.float64) ** 2).sum(1))
        for share in (*SHARES, None):
            threshold = np.full(len(todo), -np.inf) if share is None else share * largest * norms
            parts = []
            for i, j, score in index.search(a[todo], threshold):
                other = anchor_ids[todo[i]] != ids[mine[j]]
                parts.append(_best(i[other], mine[j[other]], score[other], ids, POSITIVES))
            i, j, score = (np.concatenate(p) for p in zip(*parts))
            full = np.bincount(i, minlength=len(todo)) >= POSITIVES
            if share is None:
                full[:] = True
            keep = full[i]
            yield todo[i[keep]], j[keep], score[keep]
            todo, norms = todo[~full], norms[~full]
            if not len(todo):
                break


def block_negatives(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Within a block, the first NEGATIVES rows of each window: (window, row, score) positions.

    A window is a positive of an anchor, in the order of the column ``positives``.
    An anchor is searched with the lowest threshold of its windows that are not
    full yet.
    """
    x, a = _pair(rows, anchors)
    ids, labels, own = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), anchors["label"].to_numpy()
    counts, upper = windows_of(anchors)
    first = np.concatenate([[0], np.cumsum(counts)])
    lower = -(-LOW * upper // WHOLE)
    index = StripIndex(x)
    open_ = lower * WHOLE <= HIGH * upper
    of = np.repeat(np.arange(len(counts)), counts)
    for step in STEPS:
        todo = np.unique(of[open_])
        if not len(todo):
            break
        floor = np.where(open_, np.maximum(lower, -(-step * upper // WHOLE)), np.iinfo(np.int64).max)
        least = np.minimum.reduceat(floor, first[todo]) if len(todo) else floor
        for i, j, score in index.search(a[todo], least.astype(np.float64)):
            i = todo[i]
            fits = own[i] != labels[j]
            i, j, score = i[fits], j[fits], score[fits]
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            at, starts = np.unique(i, return_index=True)
            for anchor, low, high in zip(at, starts, np.append(starts[1:], len(i))):
                falling = -score[low:high]
                for w in range(first[anchor], first[anchor + 1]):
                    if open_[w]:
                        begin = np.searchsorted(falling, -(HIGH * upper[w] // WHOLE))
                        end = min(np.searchsorted(falling, -floor[w], "right"), begin + NEGATIVES)
                        if end - begin == NEGATIVES or step == STEPS[-1]:
                            open_[w] = False
                            taken = slice(low + begin, low + max(begin, end))
                            yield np.full(max(0, end - begin), w), j[taken], score[taken]


def windows_of(anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Windows of each anchor, and their positives' scores one after the other."""
    lists = anchors["positives"].combine_chunks()
    return np.diff(lists.offsets.to_numpy()), lists.flatten().field("score").to_numpy()


def _found(parts: list, rows: pa.Table) -> tuple[pa.Array, dict[str, pa.Array]]:
    i, j, score = (np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
    return pa.array(i, pa.int64()), {"row_id": rows["vec_id"].combine_chunks().take(pa.array(j, pa.int64())),
                                     "score": pa.array(score, pa.int64())}


def positives_task(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    at, found = _found(list(block_positives(rows, anchors)) if len(rows) and len(anchors) else [], rows)
    return pa.table({"anchor_id": anchors["vec_id"].combine_chunks().take(at), **found})


def negatives_task(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    at, found = _found(list(block_negatives(rows, anchors)) if len(rows) and len(anchors) else [], rows)
    windows = anchors["positives"].combine_chunks()
    owner = pa.array(np.repeat(anchors["vec_id"].to_numpy(), windows_of(anchors)[0]))
    return pa.table({"anchor_id": owner.take(at), "positive_id": windows.flatten().field("id").take(at),
                     "positive_score": windows.flatten().field("score").take(at), **found})


def prepared(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part: label, id and vector are there, all components are finite.

    Of rows with one id the least by label, then vector, stands for it. Components
    become whole numbers, floor(256 x). Scores must fit 64 bits and their parts
    53, as they do for components up to about 2^17 and some hundred dimensions.
    """
    rows = keep_only(embeddings, "vec_id", "label", "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter(F.forall("embedding", finite))
    vec = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    one = rows.select("vec_id", F.col("label").cast("long").alias("label"), vec.alias("vec"))
    return one.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row")).select("vec_id", "row.*")


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, task: Callable, schema: str) -> DataFrame:
    """Every block of anchors meets every block of rows once."""
    by_row, by_anchor = -(-max(n_rows, 1) // ROWS), -(-max(n_anchors, 1) // ANCHORS)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = rows.select("*", block(by_row, 1).alias("_row"), each(by_anchor).alias("_anchor"))
    right = anchors.select("*", block(by_anchor, 2).alias("_anchor"), each(by_row).alias("_row"))
    return left.groupBy("_row", "_anchor").cogroup(right.groupBy("_row", "_anchor")).applyInArrow(task, schema)


def mine(rows: DataFrame, anchors: DataFrame, staging: Staging) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` have vec_id, label, vec as ``prepared`` gives them.
    Every block returns its own first rows; the first of those are the first of
    all. No anchors or no rows give no rows; ties go to the smaller id.
    """
    rows, anchors = staging.table(rows, "rows"), staging.table(anchors, "anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    near = _met(rows, anchors, n_rows, n_anchors, positives_task, "anchor_id long, row_id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "row_id")
    positives = near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= POSITIVES).groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("n", F.col("row_id").alias("id"), "score"))).alias("positives"))
    windows = staging.table(anchors.join(positives, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "windows")
    far = _met(rows, windows, n_rows, n_anchors, negatives_task,
               "anchor_id long, positive_id long, positive_score long, row_id long, score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "row_id")
    return far.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    staging = Staging(spark)
    rows = staging.table(prepared(spark.read.parquet(f"{folder}/embeddings.parquet")), "prepared")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0), staging)

"""Packing by lexical retrieval.

Each task cuts its documents into index shards of bounded size. A shard holds a
BM25 inverted index over its documents, with token ids as terms. A seed document
opens a window; the index returns its unused neighbours, best first, and they
fill the window. The neighbour that no longer fits is cut there, and its rest is
the next seed, so windows are full; only the last one of a task is not. No text
is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cleartab.llm.common import documents
from cleartab.llm.tokens import encoded_batches, id_and_text

WINDOW = 2048
SHARD_DOCUMENTS = 512
SHARD_TOKENS = 1_000_000
"""A shard closes with the document that reaches either bound, so memory is bounded by these and one document."""
K1, B = 1.2, 0.75

PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
         "sequence_id bigint, offset bigint")


class Index:
    """BM25 inverted index of one shard; posting lists hold (document, weight)."""

    def __init__(self, ids: list[np.ndarray]):
        sizes = np.array([len(x) for x in ids], dtype=np.float64)
        keys = np.concatenate([x.astype(np.uint64) << np.uint64(24) | np.uint64(i) for i, x in enumerate(ids)])
        keys, tf = np.unique(keys, return_counts=True)
        terms, self.docs = keys >> np.uint64(24), (keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        self.terms, first, df = np.unique(terms, return_index=True, return_counts=True)
        self.bounds = np.append(first, len(terms))
        idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        self.weights = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.docs])
        self.count = len(ids)

    def ranked(self, ids: np.ndarray) -> np.ndarray:
        """All documents of the shard, best first, ties by place."""
        query = np.unique(ids)
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)]
        starts, lengths = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        total = int(lengths.sum())
        scores = np.zeros(self.count)
        if total:
            hits = np.arange(total) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
            scores = np.bincount(self.docs[hits], weights=self.weights[hits], minlength=self.count)
        return np.argsort(-scores, kind="stable")


def shards(docs: Iterable[tuple[int, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    held, tokens = [], 0
    for doc in docs:
        held.append(doc)
        tokens += len(doc[1])
        if len(held) >= SHARD_DOCUMENTS or tokens >= SHARD_TOKENS:
            yield held
            held, tokens = [], 0
    if held:
        yield held


def packed(docs: Iterable[tuple[int, np.ndarray]], first: int = 0, window: int = WINDOW) -> Iterator[tuple]:
    """Pieces (doc_id, ids, start, stop, sequence, offset); each id of each document lies in exactly one."""
    sequence, filled, seed = first, 0, None
    for shard in shards(docs):
        index = Index([ids for _, ids in shard])
        unused = np.ones(len(shard), dtype=bool)
        neighbours = iter(index.ranked(seed)) if filled else None  # of the window left open by the last shard
        for _ in range(len(shard)):
            if filled:
                chosen = next(i for i in neighbours if unused[i])
            else:
                chosen = int(unused.argmax())
            unused[chosen] = False
            doc_id, ids = shard[chosen]
            start, opens = 0, filled == 0
            while start < len(ids):
                stop = min(len(ids), start + window - filled)
                yield doc_id, ids, start, stop, sequence, filled
                filled += stop - start
                start = stop
                if filled == window:
                    sequence, filled, opens = sequence + 1, 0, True
            if opens and filled:  # this document, or its rest, is the seed of the open window
                seed, neighbours = ids, iter(index.ranked(ids))


def piece_row(doc_id, ids, start, stop, sequence, offset) -> tuple:
    return doc_id, start, stop - start, zlib.crc32(ids[start:stop].tobytes()), len(ids), sequence, offset


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece, see ``PIECE``.

    Repeated rows are packed one by one, ties in a ranking go by place in the
    shard, an empty table gives no rows, further columns are not read. Numbers
    of sequences are unique; a task counts from its own number times 2^33.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = [c.split()[0] for c in PIECE.split(", ")]
        rows: list[tuple] = []
        for piece in packed(encoded_batches(batches), TaskContext.get().partitionId() << 33):
            rows.append(piece_row(*piece))
            if len(rows) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return id_and_text(docs).mapInArrow(run, PIECE)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))

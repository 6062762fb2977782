"""Best-fit-decreasing packing into token-id matrices.

Each task packs its own documents in lots of bounded size. Overlong documents
are split into whole windows and a rest, losslessly. The pieces of a lot go,
longest first, into the open sequence with the least room that still takes
them; a segment tree over room finds it in a logarithmic number of steps. A
packed row has its ids, the cumulative lengths of its segments and positions
that start again at each segment.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.llm.common import documents
from cleartab.llm.tokens import encoded_batches, id_and_text

WINDOW = 2048
LOT_TOKENS = 4_000_000
"""A lot closes with the document that reaches this many tokens."""
PAD = 0

PACKED = ("sequence_id bigint, n_tokens int, doc_ids array<bigint>, starts array<bigint>, cu_seqlens array<int>, "
          "ids binary, positions binary")


class RoomTree:
    """Segment tree over amounts of room; a node counts the open sequences below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open.setdefault(room, []).append(sequence)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns (room, sequence) of the tightest sequence with room for ``size``."""
        node = self.leaves + size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up, until a right neighbour has some
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:  # down, as far left as possible
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Groups of the numbers of ``sizes`` (each at most ``window``) that share a sequence."""
    tree, sequences = RoomTree(window), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            found = window, len(sequences)
            sequences.append([])
        room, sequence = found
        sequences[sequence].append(i)
        if room > sizes[i]:
            tree.put(room - sizes[i], sequence)
    return sequences


def packed(docs: Iterable[tuple[int, np.ndarray]], window: int = WINDOW) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Sequences as lists of (doc_id, start, ids)."""
    def lots():
        held, tokens = [], 0
        for doc_id, ids in docs:
            for start in range(0, len(ids), window):
                held.append((doc_id, start, ids[start:start + window]))
            tokens += len(ids)
            if tokens >= LOT_TOKENS:
                yield held
                held, tokens = [], 0
        if held:
            yield held

    for lot in lots():
        for sequence in best_fit([len(ids) for _, _, ids in lot], window):
            yield [lot[i] for i in sequence]


def matrix_row(sequence_id: int, pieces: list[tuple[int, int, np.ndarray]], window: int = WINDOW) -> tuple:
    lengths = [len(ids) for _, _, ids in pieces]
    filled = sum(lengths)
    ids, positions = np.full(window, PAD, dtype="<u4"), np.zeros(window, dtype="<u4")
    ids[:filled] = np.concatenate([x for _, _, x in pieces])
    positions[:filled] = np.concatenate([np.arange(n) for n in lengths])
    return (sequence_id, filled, [d for d, _, _ in pieces], [s for _, s, _ in pieces],
            [0, *np.cumsum(lengths).tolist()], ids.tobytes(), positions.tobytes())


def pack(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per sequence, see ``PACKED``; ids and positions are little-endian unsigned 32-bit, padded to the window.

    A null text is empty and, like every document, ends with the separator.
    Repeated rows are packed one by one; equal lengths keep their order; an
    empty table gives no rows; further columns are not read.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.binary(), pa.binary()]
        names = [c.split()[0] for c in PACKED.split(", ")]
        rows: list[tuple] = []
        first = TaskContext.get().partitionId() << 33
        for i, pieces in enumerate(packed(encoded_batches(batches), window)):
            rows.append(matrix_row(first + i, pieces, window))
            if len(rows) == 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return id_and_text(docs).mapInArrow(run, PACKED)


def write_packed(docs: DataFrame, path: str) -> None:
    pack(docs).write.parquet(path)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The packed matrix, whole: ids, cumulative lengths and positions, and a checksum of the positions."""
    return pack(documents(spark, folder)).withColumn("positions_crc32", F.crc32("positions"))

"""Exact set-similarity links among blocks of n-gram sets, by walking a prefix tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


CELLS = 64_000_000
"""Entries of a table of n-grams by sets."""


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of sets with 100 * common >= percent * union; i < j within ``left`` where ``right`` is None.

    Sets are sorted arrays of distinct numbers, the global order. The sets of
    ``left``, in lexicographic order, are the leaves of a prefix tree. It is
    walked from the root with all sets of the other side at once: a shared path
    is compared once for all leaves below it, and a set leaves the walk where
    even a full match of what remains cannot reach the threshold.
    """
    others = left if right is None else right
    sizes = np.array([len(x) for x in others])
    vocabulary, times = np.unique(np.concatenate(others), return_counts=True) if others else (np.array([], dtype=np.uint64),) * 2
    # Of account is only what two different sets may share.
    vocabulary = vocabulary[times > 1] if right is None else np.intersect1d(vocabulary, np.concatenate([vocabulary[:0], *left]))
    if not len(vocabulary):
        return
    dense = len(others) > 4
    if dense and len(others) * len(vocabulary) > CELLS:  # half of the others at a time
        half = len(others) // 2
        if right is not None:
            yield from linked(left, right[:half], percent)
            yield from ((i, half + j) for i, j in linked(left, right[half:], percent))
        else:
            yield from linked(left[:half], None, percent)
            yield from ((half + i, half + j) for i, j in linked(left[half:], None, percent))
            yield from ((i, half + j) for i, j in linked(left[:half], left[half:], percent))
        return

    def places(tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(vocabulary, tokens), len(vocabulary) - 1)
        return at[vocabulary[at] == tokens]

    if dense:
        has = np.zeros((len(vocabulary), len(others)), dtype=np.uint8)
        for j, x in enumerate(others):
            has[places(x), j] = 1

    def common(tokens: np.ndarray, alive: np.ndarray) -> np.ndarray:
        if dense:
            return has[places(tokens)][:, alive].sum(axis=0, dtype=np.int64)
        out = np.empty(len(alive), dtype=np.int64)
        for k, j in enumerate(alive):
            at = np.minimum(np.searchsorted(others[j], tokens), len(others[j]) - 1)
            out[k] = np.count_nonzero(others[j][at] == tokens)
        return out

    def needed(size, other):
        return -(-percent * (size + other) // (100 + percent))

    order = sorted(range(len(left)), key=lambda i: left[i].tolist())
    if right is None and any(len(x) == 0 for x in left):
        order = [i for i in order if len(left[i])]
    lengths = np.array([len(left[i]) for i in order])
    stack = [(0, len(order), 0, np.flatnonzero(sizes), np.zeros(np.count_nonzero(sizes), dtype=np.int64))] if order else []
    while stack:
        low, high, depth, alive, shared = stack.pop()
        first, last = left[order[low]], left[order[high - 1]]
        most = min(len(first), len(last))
        differs = np.flatnonzero(first[depth:most] != last[depth:most])
        end = depth + int(differs[0]) if len(differs) else most
        if end > depth:
            shared = shared + common(first[depth:end], alive)
        longest, shortest = int(lengths[low:high].max()), int(lengths[low:high].min())
        possible = shared + np.minimum(longest - end, sizes[alive] - shared) >= needed(shortest, sizes[alive])
        alive, shared = alive[possible], shared[possible]
        if not len(alive):
            continue
        while low < high and lengths[low] == end:  # sets that end here
            i = order[low]
            for j in alive[shared >= needed(end, sizes[alive])].tolist():
                if right is not None or i < j:
                    yield i, j
            low += 1
        while low < high:  # children: runs with the same next number
            token, start = left[order[low]][end], low
            while low < high and left[order[low]][end] == token:
                low += 1
            stack.append((start, low, end, alive, shared))


class Sets:
    """Union-find over a handful of local numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def spanning(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> Iterable[tuple[int, int]]:
    """A subset of the links that connects whatever all links connect."""
    sets = Sets(len(left) + len(right or []))
    shift = 0 if right is None else len(left)
    return [(i, j) for i, j in linked(left, right, percent) if sets.join(i, j + shift)]

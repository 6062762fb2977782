"""Powers for hashes of all words or shingles of a block in one pass."""

from __future__ import annotations

import numpy as np

ODD = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", ODD), ("down", pow(ODD, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]

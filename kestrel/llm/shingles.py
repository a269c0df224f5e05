"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads the combined word hashes evenly over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """One hash per shingle position of the lower-cased (A-Z) words; with fewer than
    ``width`` words the whole sequence is the one shingle; none without words."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    span = min(n, width)
    key = np.full(n - span + 1, span, np.uint64)  # sequences of different length differ
    for j in range(span):
        key = key * _ODD + h[j:j + n - span + 1]
    return _mix(key)


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(text, width))

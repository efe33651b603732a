"""Hashed word shingles of a text."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word; a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    values = (values ^ (values >> np.uint64(27))) * _STEP
    return values ^ (values >> np.uint64(31))


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix(out * _STEP + hashes[i : i + n])
    return out


def shingle_set(data: bytes, memo: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles of ``size`` words; of fewer words the whole sequence; of none nothing.

    Words are runs outside x20 and x09-x0D, A-Z lower-cased.
    """
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    # the length goes in, so that a short text is no shingle of a longer one
    return np.unique(combine(hashes, min(size, len(words))) + np.uint64(min(size, len(words))))

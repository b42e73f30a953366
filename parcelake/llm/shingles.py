"""Words and hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_KEEP = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters; null has none."""
    return (text or "").lower().encode().translate(_KEEP).split()


def shingle_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles.

    A text of one to n - 1 words has one shingle, all its words; one without words has none.
    """
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(n, len(own))
    value = np.full(len(own) - n + 1, n, np.uint64)
    for offset in range(n):
        value = value * _FACTOR + own[offset:len(own) - n + 1 + offset]
    value ^= value >> np.uint64(32)
    value *= _MIX
    value ^= value >> np.uint64(29)
    return np.unique(value)

"""Hashed word shingles of whole texts, for functions that run on executors."""

from __future__ import annotations

import re

import numpy as np
import xxhash

K = 5
_WORD = re.compile(r"\w+")
_REMEMBERED = 1 << 17


class WordHashes(dict):
    """64-bit hashes by word, remembered; forgets all beyond a size, which only costs time."""

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


_known = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words in their order."""
    found = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_known.__getitem__, found), dtype=np.uint64, count=len(found))


def rolled(w: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of k words; of all words together if there are fewer; none without words."""
    if not len(w):
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + n]
    return mixed(h)

"""Hashed word shingles of whole texts, for tasks in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import mix

SIZE = 5
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word met so far; forgets all when it has grown to ``limit`` words."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes | None, words: WordHashes) -> np.ndarray:
    """Hash of each shingle of ``SIZE`` words in order; A-Z are lower-cased, words end at ASCII white space.

    A shorter text is one shingle; a text without words has none.
    """
    parts = (text or b"").lower().split()
    n = len(parts)
    hashed = np.fromiter((words[w] for w in parts), np.uint64, n)
    size = min(SIZE, n)
    if not n:
        return hashed
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = total * FACTOR + hashed[i : n - size + 1 + i]
    return mix(total)

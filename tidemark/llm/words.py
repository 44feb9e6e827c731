"""Words, word hashes and shingles of texts, computed inside tasks with numpy.

Words are the runs of non-white-space of the lower-cased text; a shingle is five consecutive words, or all words of a
text that has fewer. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """word -> 64-bit hash, computed once for each word met; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_HASHES = WordHashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return _HASHES.of(words)


def forget_words() -> None:
    """Empty this worker's table of words, at the end of a task: later stages in the same worker have other uses for the memory."""
    _HASHES.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX
    return h ^ (h >> np.uint64(27))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (empty if there are fewer)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= _MUL
        out += hashes[k:k + count]
    return mix(out)


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; none if it has no word."""
    words = text.lower().split() if text else []
    return np.unique(gram_hashes(word_hashes(words), min(n, len(words)))) if words else np.empty(0, dtype=np.uint64)

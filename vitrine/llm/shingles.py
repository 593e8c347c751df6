"""Word shingles as 64-bit hashes, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
MEMORY_WORDS = 500_000

_U = np.uint64


class _Words(dict):
    """Hashes of words seen by this worker; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_memory = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_memory.__getitem__, words), _U, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of ``size`` words, in text order; a shorter sequence is
    one shingle, no words none."""
    n = len(words)
    width = min(size, n)
    if not n:
        return words
    h = np.full(n - width + 1, width, _U)
    for i in range(width):
        h = h * _U(0x9E3779B97F4A7C15) + words[i:n - width + 1 + i]
    return mixed(h)

"""Hashed word shingles and MinHash sketches, in numpy inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SIZE = 5
POSITIONS = 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KNOWN_WORDS = 100_000  # word hashes a task remembers

_MIX = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = np.random.Generator(np.random.PCG64(21)).integers(1, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of SIZE words; of the whole text if it has fewer."""
    words = WORD.findall(text or "")
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([hashes[w] for w in words], np.uint64)
    size = min(SIZE, len(h))
    n = len(h) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = _scramble(total + h[k : k + n] * _MIX[k])
    return np.unique(total)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least value of POSITIONS hash functions over the set, 32 bits each."""
    low = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), 4096):
        part = shingles[begin : begin + 4096]
        mixed = _SEEDS[:, None] * part[None, :]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        low = np.minimum(low, mixed.min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)

"""Words as 64-bit hashes, shingles and shingle sets, in NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers that keep the places of a shingle's words apart; fixed values.
_PLACES = np.random.default_rng(20240229).integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Words remembered by a task; beyond them the memory starts anew.
REMEMBERED = 400_000


class WordHashes(dict):
    """Hash of each word, kept for the next time it is seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of a shorter text its whole sequence, as one."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(size, n)
    total = words[: n - width + 1] * _PLACES[0]
    for i in range(1, width):
        total += words[i : n - width + 1 + i] * _PLACES[i]
    if width < size:
        total += np.uint64(width)
    return mixed(total)


def split_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and \\t to \\r, with A-Z lower-cased."""
    return text.lower().split()


def shingle_set(text: bytes, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingles of a text."""
    return np.unique(shingles(known.of(split_words(text)), size))


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``threshold`` (hundredths)."""
    if not len(a) or not len(b):
        return False
    percent = round(threshold * 100)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)

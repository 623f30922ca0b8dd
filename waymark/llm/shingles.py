"""Words of a text as 64-bit numbers, and numbers for runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 1 << 17
#: Odd multiplier of the rolling hash over words.
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered for at most ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = WordHashes()


def space_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs ``[^\\x20\\x09-\\x0D]+`` as UTF-8, ASCII letters lower-cased if asked; null: none."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def hash_words(words: list[bytes]) -> np.ndarray:
    """One unsigned 64-bit number per word."""
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A scrambled number for each run of ``k`` words; empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n].copy()
    for j in range(1, k):
        total = total * STEP + words[j : j + n]
    return mix(total)


def shingle_set(text: str | None, k: int, lower: bool = True) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; a text of fewer words, but not none, is one."""
    words = space_words(text, lower)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = hash_words(words)
    # the length sets a short text's only shingle apart from all others
    return np.unique(run_hashes(h, k)) if len(h) >= k else mix(run_hashes(h, len(h)) + np.uint64(len(h)))

"""Word shingles and minhashes of whole texts, vectorised with numpy.

Used inside Arrow batches (``mapInPandas``); nothing here touches Spark.
"""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1


class WordHashes(dict):
    """word bytes -> 64-bit hash, filled on first use and emptied when it
    holds ``bound`` words, so a worker's memory stays bounded."""

    def __init__(self, bound: int = 500_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), element-wise."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def odd_constants(n: int, seed: str) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers derived from ``seed``."""
    return np.array([xxhash.xxh3_64_intdigest(f"{seed}/{i}".encode()) | 1 for i in range(n)], dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (``bytes.lower`` and
    ``bytes.split`` do exactly these ASCII rules); null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], hashes: WordHashes, width: int, weights: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; a shorter
    text is one shingle, its whole sequence; no words: empty."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) < width:
        # the length takes part, so it can't equal a full shingle's sum
        return mix(np.array([int((h * weights[: len(h)]).sum()) & _MASK], dtype=np.uint64) + np.uint64(len(h)))
    n = len(h) - width + 1
    s = h[:n] * weights[0]
    for i in range(1, width):
        s += h[i : n + i] * weights[i]
    s = np.sort(mix(s))
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def minhashes(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """(documents x hash functions) minima of the mixed values; every set must
    be non-empty. One pass over the concatenated sets per hash function."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), len(multipliers)), dtype=np.uint64)
    for k, a in enumerate(multipliers):
        x = flat * a
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out

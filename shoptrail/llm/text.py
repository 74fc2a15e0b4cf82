"""Word and shingle kernels shared by the operators (numpy, used inside tasks).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is how
``bytes.split()`` cuts. Word hashes are xxh64 of the UTF-8 bytes; a k-word
shingle is a position-weighted sum of its word hashes, finalised, so equal
word sequences have equal 64-bit hashes on every machine and in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U = np.uint64
_MASK = (1 << 64) - 1
_CACHE_WORDS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (vectorised, wraps modulo 2**64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _weights(k: int, salt: int) -> np.ndarray:
    w = mix((np.arange(1, k + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) + U(salt))
    return w | U(1)


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text; null has none. Only A-Z are lower-cased."""
    if text is None:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHashes(dict):
    """word -> xxh64, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def windows(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (empty if fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for i, c in enumerate(_weights(k, salt)):
        acc += h[i:i + n] * c
    return mix(acc)


def shingle_set(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingles; with fewer words the whole sequence
    is the one shingle; without words the set is empty."""
    if len(h) == 0:
        return h
    if len(h) < k:
        return windows(h, len(h), salt=len(h))
    return np.unique(windows(h, k))


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about ``limit`` (at least one each)."""
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield start, i
            start, total = i, 0
        total += s
    if start < len(sizes):
        yield start, len(sizes)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark longs."""
    return x.view(np.int64)

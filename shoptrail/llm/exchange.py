"""Packed exchanges between blocks of documents and buckets of hashes.

A block task sends its distinct hashes to hash buckets as a few rows of packed
arrays instead of one row a hash; a bucket sees each hash at most once from
each block, however many rows of the block hold it (hot hashes are reduced
before the shuffle), and answers the blocks the same way. The number of
buckets follows the input, so a bucket's arrays stay of one size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

from shoptrail.llm.text import U

BUCKET_BYTES = 16_000_000  # input text behind one bucket


def buckets_for(text_bytes: int) -> int:
    return max(1, -(-text_bytes // BUCKET_BYTES))


def deal(hashes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices of its hashes) for each bucket that gets any."""
    if len(hashes) == 0:
        return
    to = ((hashes >> U(24)) % U(n)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    for part in np.split(order, cuts):
        yield int(to[part[0]]), part


def joined(column: pd.Series, dtype) -> np.ndarray:
    """The packed arrays of a column, one after the other."""
    return np.frombuffer(b"".join(column), dtype=dtype)


def lengths(column: pd.Series, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in column], np.int64)


def parts(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else []

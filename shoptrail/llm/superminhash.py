"""SuperMinHash signatures (vectorised over many sets at once).

Each element owns one random permutation of the ranks 0..m-1 and, for level
j, a uniform fraction r_j; at level j it offers the value j + r_j to the rank
its permutation names at j, and a rank keeps the least offer. Because every
offer of level j is at least j, a set whose ranks all hold values under j + 1
cannot change any more: it stops there. Running all elements level by level
gives exactly the signature of the element-by-element form, as a minimum does
not depend on order. Offers are kept as integers ``(j << 32) | r``.
"""

from __future__ import annotations

import numpy as np

from shoptrail.llm.text import U, mix

_STEP = 0x9E3779B97F4A7C15


def signatures(hashes: np.ndarray, owner: np.ndarray, n_sets: int, m: int) -> np.ndarray:
    """(n_sets, m) signatures. ``hashes``: distinct elements of each set;
    ``owner``: the set of each. Empty sets keep the largest value."""
    sig = np.full(n_sets * m, np.iinfo(np.uint64).max, np.uint64)
    if len(hashes) == 0:
        return sig.reshape(n_sets, m)
    h, g = hashes, owner.astype(np.int64)
    perm: np.ndarray | None = None
    for j in range(m):
        x = mix(h + U((_STEP * (j + 1)) & ((1 << 64) - 1)))
        frac = x >> U(32)
        k = j + ((x & U(0xFFFFFFFF)) % U(m - j)).astype(np.int64)
        if perm is None:
            rank = k
        else:
            rows = np.arange(len(h))
            rank = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        np.minimum.at(sig, g * m + rank, (U(j) << U(32)) | frac)
        open_ = sig.reshape(n_sets, m).max(axis=1) >= U((j + 1) << 32)
        active = open_[g]
        n_active = int(active.sum())
        if n_active == 0:
            break
        if perm is None:  # ranks are the identity until the first exchange
            h, g, k = h[active], g[active], k[active]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(h), 1))
            perm[np.arange(len(h)), k] = 0
        elif n_active < len(h):
            h, g, perm = h[active], g[active], perm[active]
    return sig.reshape(n_sets, m)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` ranks."""
    n, m = sig.shape
    bands = m // rows
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * U(_STEP)), (n, bands)).copy()
    for r in range(rows):
        keys = mix(keys ^ sig[:, r:bands * rows:rows]) * U(0x2545F4914F6CDD1D)
    return keys

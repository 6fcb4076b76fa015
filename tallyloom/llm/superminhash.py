"""SuperMinHash signatures in numpy.

Each element gives every signature position a rank (a permutation of 0..m-1) plus a uniform fraction, and
a position keeps the least rank + fraction over all elements.  Ranks of one element are thus correlated,
which lowers the variance of the similarity estimate against independent hashes when sets are small.
The permutation is affine over the prime field of m elements, ``position = a * rank + b``: this family is
sharply two-transitive, so single positions and pairs of positions are distributed as under a uniform
permutation, which is all that mean and variance of the estimate depend on.
Ranks are tried in rising order, and no more once every position holds a value below the next rank.
"""

from __future__ import annotations

import math

import numpy as np

from tallyloom.llm.textops import U64, mix

_EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_STEP = U64(0x9E3779B97F4A7C15)


def is_prime(m: int) -> bool:
    return m > 1 and all(m % d for d in range(2, math.isqrt(m) + 1))


def signature(elements: np.ndarray, m: int) -> np.ndarray:
    """m values (rank in the top byte, 56 random bits below) of distinct 64-bit elements; m is a prime below 256."""
    if not is_prime(m) or m > 251:
        raise ValueError("m must be a prime below 256")
    out = np.full(m, _EMPTY, dtype=U64)
    n = len(elements)
    if n == 0:
        return out
    seed = mix(elements ^ U64(0x5851F42D4C957F2D))
    a = (seed % U64(m - 1)).astype(np.int64) + 1
    b = ((seed >> U64(32)) % U64(m)).astype(np.int64)
    at, width = 0, min(m, max(1, math.ceil(1.2 * m * math.log(m) / n)))
    while at < m:
        ranks = np.arange(at, min(at + width, m))
        place = (a[:, None] * ranks + b[:, None]) % m
        value = mix(seed[:, None] + (ranks + 1).astype(U64) * _STEP) >> U64(8)
        value |= ranks.astype(U64) << U64(56)
        np.minimum.at(out, place.ravel(), value.ravel())
        at += len(ranks)
        if int(out.max()) >> 56 < at:
            break
        width = max(1, width // 2)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values; left-over values are unused."""
    bands = len(sig) // rows
    part = sig[: bands * rows].reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=U64) * _STEP
    for j in range(rows):
        key = mix(key ^ part[:, j]) + _STEP
    return key

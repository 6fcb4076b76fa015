"""Hashed byte n-grams of whole texts, in blocks of bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyloom.llm.textops import BLOCK, FOLD

_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def hashed(piece: np.ndarray, order: int, bits: int, fold: bool) -> np.ndarray:
    """Bucket of the ``order`` bytes from each position; shorter by order - 1 than ``piece``."""
    x = (FOLD[piece] if fold else piece).astype(np.uint32)
    n = len(x) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = x[:n] * np.uint32(_ODD[0])
    for j in range(1, order):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(_ODD[j]) + x[j : n + j]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(2 * order + 1)) >> np.uint32(32 - bits)).astype(np.int64)


def text_blocks(raw: np.ndarray, offsets: np.ndarray, overlap: int, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, bytes, last) pieces of single rows; a long row comes in pieces that overlap by ``overlap`` bytes."""
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        while hi - lo > size:
            yield i, raw[lo : lo + size], False
            lo += size - overlap
        yield i, raw[lo:hi], True

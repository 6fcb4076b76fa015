"""Vectorised word and n-gram hashing over Arrow string buffers.

Everything here works on raw UTF-8 bytes, so no Python string is made per word.  A word is a run of
bytes that are not space or \\x09-\\x0D; A-Z are lower-cased.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U64 = np.uint64

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (new array)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))[FOLD.astype(np.int64)]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(BLOCK, n) if have is None else max(n, 2 * len(have))
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps, dtype=U64)
    return have[:n]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row offsets (n + 1, from 0) and null flags of a string or binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    n, at = len(column), column.offset
    nulls = np.zeros(n, dtype=bool) if not column.null_count else column.is_null().to_numpy(zero_copy_only=False)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), nulls
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0], nulls


def blocks(raw: np.ndarray, offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that end at a row's end or at a separator."""
    at, n = 0, len(raw)
    while at < n:
        end = min(at + size, n)
        if end < n:
            row_end = int(offsets[np.searchsorted(offsets, end, "left")])
            while end < row_end:
                window = SEPARATOR[raw[end : min(end + 65536, row_end)]]
                k = int(window.argmax())
                if window[k]:
                    end += k
                    break
                end += len(window)
        yield at, end
        at = end


def words(raw: np.ndarray, offsets: np.ndarray, positions: bool = False) -> tuple[np.ndarray, ...]:
    """Word hashes of all rows in order, and the bounds (n + 1) of each row's words among them; on request each word's first byte."""
    hashes, firsts = [], []
    for lo, hi in blocks(raw, offsets):
        piece = raw[lo:hi]
        inside = ~SEPARATOR[piece]
        if not inside.any():
            continue
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        a, b = np.searchsorted(offsets, [lo, hi], "left")
        edges = offsets[a:b] - lo  # row starts inside the block
        edges = edges[edges < len(piece)]
        begin[edges] |= inside[edges]
        starts = np.flatnonzero(begin)
        value = _BYTE[piece]
        value[~inside] = 0
        value *= _power_table(_BASE, len(piece))
        total = np.empty(len(piece) + 1, dtype=U64)
        total[0] = 0
        np.cumsum(value, out=total[1:])
        ends = np.append(starts[1:], len(piece))  # separators add nothing
        h = (total[ends] - total[starts]) * _power_table(_BASE_INVERSE, len(piece))[starts]
        hashes.append(mix(h))
        firsts.append(starts + lo)
    if not hashes:
        none = np.zeros(0, U64), np.zeros(len(offsets), np.int64)
        return (*none, np.zeros(0, np.int64)) if positions else none
    first = np.concatenate(firsts)
    found = np.concatenate(hashes), np.searchsorted(first, offsets, "left")
    return (*found, first) if positions else found


_MULTIPLIERS = mix(np.arange(101, 165, dtype=U64)) | U64(1)


def shingles(row: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of a row's k-word shingles; a shorter row is one shingle, an empty one none."""
    n = len(row)
    if n == 0:
        return row
    if n < k:
        # arrays of one, since numpy warns of overflow in scalars
        return mix((row * _MULTIPLIERS[:n]).sum(dtype=U64, keepdims=True) + np.array([n], dtype=U64) * _MULTIPLIERS[63:64])
    total = row[: n - k + 1] * _MULTIPLIERS[0]
    for j in range(1, k):
        total += row[j : n - k + 1 + j] * _MULTIPLIERS[j]
    return np.unique(mix(total))

"""A table from byte spans (words) to what was once worked out for them, looked up by whole arrays.

A span is known by its first and last eight bytes, its length and a 64-bit hash of all of it; up to 16 bytes that is the
span itself.  Spans lie in an open-addressing hash table; those that are not known are handed, each once, to a function that gives
their ids.  The table is emptied when it is full, so its memory stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

from tallyloom.llm.textops import U64, mix

PAD = 16
LONG = 128
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U64)
_STEP = U64(0x9E3779B97F4A7C15)


def padded(raw: np.ndarray) -> np.ndarray:
    """A copy of ``raw`` with PAD zero bytes before and behind it, so that eight bytes can be read at every place."""
    out = np.zeros(len(raw) + 2 * PAD, dtype=np.uint8)
    out[PAD : PAD + len(raw)] = raw
    return out


def identity(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(4, n): hash, first eight bytes, last eight bytes and length of spans of a padded buffer; places are those of the unpadded one."""
    window = np.ndarray(len(buf) - 7, dtype="<u8", buffer=buf, strides=(1,))
    size = ends - starts
    lo, hi = starts + PAD, ends + PAD
    out = np.empty((4, len(starts)), dtype=U64)
    out[1] = window[lo] & _MASK[np.minimum(size, 8)]
    out[2] = window[hi - 8] & ~_MASK[8 - np.minimum(size, 8)]
    out[3] = size.astype(U64)
    h = mix(out[1] + out[3] * _STEP)
    h = mix(h ^ (out[2] + _STEP))
    live = np.flatnonzero(size > 16)
    at = 8
    while len(live):
        h[live] = mix(h[live] ^ (window[lo[live] + at] + _STEP))
        at += 8
        live = live[size[live] > at + 8] if at < LONG else live[:0]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[lo[i] : hi[i]].tobytes(), digest_size=8).digest(), "little")
    out[0] = h
    return out


class Slots:
    """An open-addressing hash table from rows of 64-bit keys (the first of them a hash) to the numbers 0, 1, ... they were added under."""

    def __init__(self, width: int = 1, room: int = 1 << 12) -> None:
        self.keys = np.zeros((width, room), dtype=U64)
        self.n = 0
        self._deal(4 * room)

    def _deal(self, size: int) -> None:
        self.size = 1 << (size - 1).bit_length()
        self.slot = np.full(self.size, -1, dtype=np.int32)
        self._place(np.arange(self.n))

    def _place(self, numbers: np.ndarray) -> None:
        at = (self.keys[0, numbers] & U64(self.size - 1)).astype(np.int64)
        while len(numbers):
            free = self.slot[at] < 0
            self.slot[at[free]] = numbers[free]
            left = self.slot[at] != numbers
            numbers, at = numbers[left], (at[left] + 1) & (self.size - 1)

    def add(self, keys: np.ndarray) -> None:
        """Add distinct keys that are not in the table."""
        m = keys.shape[1]
        while self.n + m > self.keys.shape[1]:
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)], axis=1)
        self.keys[:, self.n : self.n + m] = keys
        self.n += m
        if 3 * self.n > self.size:
            self._deal(8 * self.n)
        else:
            self._place(np.arange(self.n - m, self.n))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        out = np.full(keys.shape[1], -1, dtype=np.int64)
        at = (keys[0] & U64(self.size - 1)).astype(np.int64)
        live = np.arange(len(out))
        while len(live):
            got = self.slot[at].astype(np.int64)
            same = got >= 0
            for mine, theirs in zip(self.keys, keys, strict=True):
                same &= mine[got] == theirs[live]
            out[live[same]] = got[same]
            left = np.flatnonzero(~same & (got >= 0))
            live, at = live[left], (at[left] + 1) & (self.size - 1)
        return out


Learn = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


class SpanTable:
    """Ids and a flag of spans.  ``learn(buf, starts, ends)`` gives, for distinct spans, all their ids in a row, how many each has, and the flags."""

    def __init__(self, learn: Learn, most: int = 1 << 20, most_ids: int = 1 << 23) -> None:
        self.learn, self.most, self.most_ids = learn, most, most_ids
        self.clear()

    def clear(self) -> None:
        self.slots = Slots(4)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0
        self.first, self.flag = np.zeros(1, np.int64), np.zeros(0, bool)

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each span, all learned; valid until the next call."""
        keys = identity(buf, starts, ends)
        at = self.slots.find(keys)
        miss = np.flatnonzero(at < 0)
        if not len(miss):
            return at
        if self.slots.n and (self.slots.n + len(np.unique(keys[0, miss])) > self.most or self.used > self.most_ids):
            self.clear()
            miss = np.arange(len(at))
        order = miss[np.lexsort(keys[::-1, miss])]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)
        one = np.sort(order[new])
        ids, count, flag = self.learn(buf, starts[one], ends[one])
        if len(count) != len(one) or int(count.sum()) != len(ids):
            raise RuntimeError("a span was lost in learning")
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.flag = np.concatenate([self.flag, flag])
        self.slots.add(keys[:, one])
        at[miss] = self.slots.find(keys[:, miss])
        return at

    def ids_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of spans by number, in a row, and the place behind each."""
        lo = self.first[at]
        count = self.first[at + 1] - lo
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        return self.ids[np.arange(total) + np.repeat(lo - stop + count, count)], stop


def gathered(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans of a padded buffer in a row, each followed by the byte ``gap``, and the place of each."""
    size = ends - starts + 1
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    out = buf[np.arange(total) + np.repeat(starts + PAD - stop + size, size)]
    out[stop - 1] = gap
    return out, stop - size

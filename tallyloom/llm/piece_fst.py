"""SentencePiece encoding and decoding by weighted finite-state transducers.

Machines are compiled from a model file:

* the *normaliser* rewrites the longest matches of the model's character map, drops or keeps runs of spaces, and writes a mark for each space
  and one in front;
* the *piece* machine is a trie: an arc reads a character, and a state that ends a piece writes its id at the weight -score and goes back to the start;
* *byte fallback* reads a character that is no piece of its own, and writes the ids of its UTF-8 bytes (or the unknown id) at a penalty;
* for BPE models, the *merge* machine remembers the last piece: its arc from piece s to piece t weighs 0 if merging the letters of
  s + t gives back (s, t), else it is infinite.  Pieces themselves weigh 0 then.  A sequence is the model's encoding if and only if each
  of its arcs is finite, and each prefix of an input has one such sequence.

An input is composed with them position by position, and the path of least weight in the tropical semiring (min, +) is its encoding;
``compose`` does this for many inputs at once, ``shortest`` for one.  Where no piece spans a word's start, words are the inputs, and
what was found for a word is kept in a table of bounded size.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows
from tallyloom.llm.spans import PAD, Slots, SpanTable
from tallyloom.llm.textops import U64, buffers, mix

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
WIDEST = 48
WINDOW = 1 << 20
FALLBACK = -2
MAX_STEPS = 1_000_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer's fields: ints, 4-byte floats, byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, data[at : at + 8]
            at += 8
        else:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Spec:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = True
    rules: dict[str, str] = field(default_factory=dict)


def read_model(path: str) -> Spec:
    """The parts of a model file that encoding needs."""
    with open(path, "rb") as f:
        data = f.read()
    spec = Spec([], [], [])
    for number, value in _fields(data):
        if number == 1:
            part = dict(_fields(value))
            spec.pieces.append(part.get(1, b"").decode())
            spec.scores.append(part.get(2, 0.0))
            spec.kinds.append(part.get(3, NORMAL))
        elif number == 2:
            part = dict(_fields(value))
            spec.model, spec.byte_fallback = part.get(3, UNIGRAM), bool(part.get(35, 0))
        elif number == 3:
            part = dict(_fields(value))
            spec.rules = read_rules(part.get(2, b""))
            spec.dummy_prefix, spec.squeeze = bool(part.get(3, 1)), bool(part.get(4, 1))
    return spec


def read_rules(blob: bytes) -> dict[str, str]:
    """What a compiled character map rewrites: a double-array trie of UTF-8 keys, whose values are places in a pool of strings."""
    if not blob:
        return {}
    size = struct.unpack("<I", blob[:4])[0]
    unit, pool = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64), blob[4 + size :]
    base = lambda at: (int(unit[at]) >> 10) << (8 if unit[at] & 512 else 0)
    labels = np.arange(1, 256)
    rules, todo = {}, [(0, b"")]
    while todo:
        at, key = todo.pop()
        children = at ^ base(at) ^ labels
        for c in labels[unit[np.minimum(children, len(unit) - 1)] & 0x800000FF == labels].tolist():
            todo.append((at ^ base(at) ^ c, key + bytes([c])))
        if key and unit[at] >> 8 & 1:
            value = int(unit[at ^ base(at)]) & 0x7FFFFFFF
            rules[key.decode()] = pool[value : pool.index(b"\0", value)].decode()
    return rules


class Normaliser:
    """Reads a text, writes it with one space for each mark (``MARK`` in the text is such a mark too)."""

    def __init__(self, spec: Spec) -> None:
        self.spec = spec
        self.single = {ord(k): v for k, v in spec.rules.items() if len(k) == 1}
        self.trie: dict = {}
        for key, value in spec.rules.items():
            node = self.trie
            for c in key:
                node = node.setdefault(c, {})
            node[""] = value
        later = {c for key in spec.rules for c in key[1:]}
        self.later = re.compile("[" + re.escape("".join(sorted(later))) + "]") if later else None

    def rewritten(self, text: str) -> str:
        """The character map's output: at each place the longest key is replaced, else the character stays."""
        if self.later is None or not self.later.search(text):
            return text.translate(self.single) if self.single else text
        out, i = [], 0
        while i < len(text):
            node, j, end, value = self.trie, i, i + 1, text[i]
            while j < len(text) and (node := node.get(text[j])) is not None:
                j += 1
                if "" in node:
                    end, value = j, node[""]
            out.append(value)
            i = end
        return "".join(out)

    def text(self, text: str) -> str:
        text = self.rewritten(text)
        if self.spec.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (" " + text if text and self.spec.dummy_prefix else text).replace(MARK, " ")

    def column(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """A column of texts normalised, and whether each is the text itself behind its front mark."""
        if self.spec.rules or self.spec.squeeze:
            texts = [x or "" for x in column.to_pylist()]
            done = [self.text(x) for x in texts]
            front = " " if self.spec.dummy_prefix else ""
            same = [not x and not y or y == front + x and MARK not in x for x, y in zip(texts, done, strict=True)]
            return pa.array(done, pa.string()), np.array(same, dtype=bool)
        column = pc.fill_null(column, "")
        marked = pc.match_substring(column, MARK)
        same = ~marked.to_numpy(zero_copy_only=False)
        if not same.all():
            column = pc.replace_substring(column, MARK, " ")
        if self.spec.dummy_prefix:
            column = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(column), 0), "", " "), column, "")
        return column, same


class PieceFst:
    def __init__(self, spec: Spec) -> None:
        self.spec = spec
        self.normaliser = Normaliser(spec)
        self.id = {p: i for i, (p, k) in enumerate(zip(spec.pieces, spec.kinds, strict=True)) if k in (NORMAL, USER) and p}
        self.byte = np.zeros(256, dtype=np.uint32)
        for i, (p, k) in enumerate(zip(spec.pieces, spec.kinds, strict=True)):
            if k == BYTE:
                self.byte[int(p[1:-1], 16)] = i
        self.unknown = spec.kinds.index(UNKNOWN) if UNKNOWN in spec.kinds else 0
        bpe = spec.model == BPE
        normal = [s for s, k in zip(spec.scores, spec.kinds, strict=True) if k == NORMAL] or [0.0]
        self.penalty = 0.0 if bpe else 10.0 - min(normal)
        #: weight of each piece
        self.weight = np.zeros(len(spec.pieces))
        for p, i in self.id.items():
            if not bpe:
                self.weight[i] = -spec.scores[i] if spec.kinds[i] == NORMAL else 0.1 - len(p.encode()) * max(normal)
        self._compile()
        front = all(MARK not in p.lstrip(MARK) for p in self.id)
        lines = all("\n" not in p for p in self.id) and spec.byte_fallback
        #: whether words, and runs of line ends, can be read on their own: no piece and no run of unknown characters spans their start
        self.by_word, self.by_line = front and (spec.byte_fallback or MARK in self.id), lines
        self.merges = _Merges(self) if bpe else None
        self.steps: dict[tuple[int, int], bool] = {}
        self.table = SpanTable(self._learn)

    def _compile(self) -> None:
        """The piece machine's arcs, (state, character) to state, and the piece that each state ends."""
        self.trie: dict = {}
        states, keys, targets, ends = [self.trie], [], [], [-1]
        first = np.full(0x110000, -1, dtype=np.int32)
        number = {id(self.trie): 0}
        for piece, i in self.id.items():
            node = self.trie
            for c in piece:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                    number[id(below)] = len(states)
                    if node is self.trie:
                        first[ord(c)] = len(states)
                    else:
                        keys.append((number[id(node)] << 21) + ord(c))
                        targets.append(len(states))
                    states.append(below)
                    ends.append(-1)
                node = below
            node[""] = i
            ends[number[id(node)]] = i
        self.first, self.ends = first, np.array(ends, dtype=np.int64)
        self.arcs, self.targets = Slots(1, max(16, len(keys))), np.array(targets, dtype=np.int64)
        self.arcs.add(mix(np.array(keys, dtype=U64))[None])
        self.alone = np.zeros(0x110000, dtype=bool)
        for p in self.id:
            if len(p) == 1:
                self.alone[ord(p)] = True
        #: characters of all pieces in a row, for the inverse machine
        self.size = np.array([len(p) if k in (NORMAL, USER) else 0 for p, k in zip(self.spec.pieces, self.spec.kinds, strict=True)], dtype=np.int64)
        self.letters = np.frombuffer("".join(p for p, k in zip(self.spec.pieces, self.spec.kinds, strict=True) if k in (NORMAL, USER)).encode("utf-32-le"), "<u4").astype(np.int64)
        self.letter_at = np.cumsum(self.size) - self.size

    def merged(self, text: str) -> list[str]:
        """The pieces that merging ends with: of all neighbours that form a piece, the best scored first, the leftmost of equals."""
        return [p for p, _, _ in self._merge(text)]

    def _merge(self, text: str) -> list[tuple[str, str, str]]:
        """(piece, and the two that it was merged from, empty for letters) of the pieces that merging ends with."""
        part: list[tuple[str, str, str] | None] = [(c, "", "") for c in text]
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = part[i][0] + part[j][0]
            if both in self.id:
                heapq.heappush(queue, (-self.spec.scores[self.id[both]], i, both))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = right[i] if part[i] is not None else len(part)
            if j >= len(part) or part[i][0] + part[j][0] != both:
                continue
            part[i], part[j] = (both, part[i][0], part[j][0]), None
            right[i] = right[j]
            if right[i] < len(part):
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [p for p in part if p is not None]

    def open(self, s: int, t: int) -> bool:
        """Whether the merge machine lets piece t follow piece s (-1: nothing)."""
        got = self.steps.get((s, t))
        if got is None:
            if len(self.steps) >= MAX_STEPS:
                self.steps.clear()
            got = self.steps[s, t] = bool(self.merges.open(np.array([s]), np.array([t]))[0])
        return got

    def shortest(self, chunk: str) -> list[int]:
        """Pieces of the least-weight path through the composition with ``chunk``; FALLBACK for a character that has none."""
        n, bpe = len(chunk), self.merges is not None
        cost, came, last = [math.inf] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            if cost[i] == math.inf:
                continue
            node, j, s = self.trie, i, last[i]
            while j < n and (node := node.get(chunk[j])) is not None:
                j += 1
                t = node.get("")
                if t is None or bpe and not self.open(max(s, -1), t):
                    continue
                c = cost[i] + float(self.weight[t])
                if c < cost[j]:
                    cost[j], came[j], last[j] = c, i, t
            if not self.alone[ord(chunk[i])]:
                c = cost[i] + self.penalty
                if c < cost[i + 1]:
                    cost[i + 1], came[i + 1], last[i + 1] = c, i, FALLBACK
        out, i = [], n
        while i:
            out.append(last[i])
            i = came[i]
        return out[::-1]

    def compose(self, code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least-weight paths of many inputs at once: all their pieces in a row, and how many each has.

        ``code`` holds the characters of all inputs, which start at ``starts`` and have at least one.
        """
        n, size = len(starts), np.diff(starts, append=len(code))
        row = np.repeat(np.arange(n), size)
        place, stop = np.arange(len(code)) - starts[row], (starts + size)[row]
        # every walk through the piece machine, from every position
        at, state = np.arange(len(code)), self.first[code].astype(np.int64)
        begins, lengths, pieces, k = [], [], [], 1
        while True:
            live = state >= 0
            at, state = at[live], state[live]
            if not len(at):
                break
            hit = self.ends[state] >= 0
            begins.append(at[hit])
            lengths.append(np.full(int(hit.sum()), k))
            pieces.append(self.ends[state[hit]])
            inside = at + k < stop[at]
            at, state = at[inside], state[inside]
            found = self.arcs.find(mix((state.astype(U64) << U64(21)) + code[at + k].astype(U64))[None])
            state = np.where(found >= 0, self.targets[found], -1) if len(self.targets) else np.full(len(at), -1)
            k += 1
        lone = np.flatnonzero(~self.alone[code])
        begins.append(lone)
        lengths.append(np.ones(len(lone), np.int64))
        pieces.append(np.full(len(lone), FALLBACK))
        begin, length, piece = np.concatenate(begins), np.concatenate(lengths), np.concatenate(pieces)
        order = np.argsort(place[begin].astype(np.int16), kind="stable")
        begin, length, piece = begin[order], length[order], piece[order]
        cuts = np.searchsorted(place[begin], np.arange(int(size.max()) + 1))
        source = begin + row[begin]  # a node for each position and one more behind each input
        target = source + length
        weight = np.where(piece >= 0, self.weight[np.maximum(piece, 0)], self.penalty)
        cost = np.full(len(code) + n, math.inf)
        came, last = np.full(len(cost), -1), np.full(len(cost), -1)
        cost[starts + np.arange(n)] = 0.0
        for i in range(len(cuts) - 1):
            here = slice(cuts[i], cuts[i + 1])
            f, t, p = source[here], target[here], piece[here]
            c = cost[f] + weight[here]
            good = c < cost[t]
            if self.merges is not None:
                ask = np.flatnonzero(good & (p >= 0))
                good[ask] = self.merges.open(np.maximum(last[f[ask]], -1), p[ask])
            f, t = f[good], t[good]
            cost[t], came[t], last[t] = c[good], f, p[good]
        node, home = starts + size + np.arange(n), starts + np.arange(n)
        rows, found = [], []
        live = np.flatnonzero(node > home)
        while len(live):
            rows.append(live)
            found.append(last[node[live]])
            node[live] = came[node[live]]
            live = live[node[live] > home[live]]
        rows_, found_ = np.concatenate(rows)[::-1], np.concatenate(found)[::-1]
        return found_[np.argsort(rows_, kind="stable")], np.bincount(rows_, minlength=n)

    def _learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct inputs, how many each has, and whether the inverse machine gives the input back."""
        size = ends - starts
        stop = np.cumsum(size)
        raw = buf[np.arange(int(stop[-1])) + np.repeat(starts + PAD - stop + size, size)]
        code = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
        code[code == 0x20] = ord(MARK)
        behind = np.cumsum((raw & 0xC0) != 0x80)[stop - 1]
        first = np.concatenate([[0], behind[:-1]])
        length = behind - first
        pieces, count = [], np.zeros(len(starts), np.int64)
        order = np.argsort(length, kind="stable")
        short = int(np.searchsorted(length[order], WIDEST, "right"))
        for lo in range(0, short, 8192):
            some = order[lo : min(lo + 8192, short)]
            n = length[some]
            at = np.cumsum(n) - n
            got, many = self.compose(code[np.arange(int(n.sum())) + np.repeat(first[some] - at, n)], at)
            pieces.append(got)
            count[some] = many
        for i in order[short:].tolist():
            got = self.shortest("".join(map(chr, code[first[i] : behind[i]].tolist())))
            pieces.append(np.array(got, dtype=np.int64))
            count[i] = len(got)
        flat = np.concatenate(pieces)
        lo = np.empty(len(order), np.int64)
        lo[order] = np.cumsum(count[order]) - count[order]
        done = np.cumsum(count)
        flat = flat[np.arange(len(flat)) + np.repeat(lo - done + count, count)]
        return self._spelled(flat, count, code, first, length)

    def _spelled(self, flat: np.ndarray, count: np.ndarray, code: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fallback characters to ids, and the inverse: pieces' letters against the input's."""
        row = np.repeat(np.arange(len(count)), count)
        bare = np.flatnonzero(flat == FALLBACK)
        ids = np.maximum(flat, 0)
        width = self.size[ids]
        width[bare] = 1
        at = np.cumsum(width) - width  # inputs lie in a row without gaps, so this is each piece's place among all characters
        read = self.letters[np.arange(len(code)) - np.repeat(at - self.letter_at[ids], width)]
        made, many = [], np.ones(len(flat), np.int64)
        for i, c in zip(bare.tolist(), code[at[bare]].tolist(), strict=True):
            if self.spec.byte_fallback:
                made.append(self.byte[np.frombuffer(chr(c).encode(), np.uint8)])
                back = self._joined(made[-1].tolist())
                read[at[i]] = ord(back) if len(back) == 1 else -1
            else:  # a run of unknown characters is one id
                made.append(np.full(0 if i and flat[i - 1] == FALLBACK and row[i - 1] == row[i] else 1, self.unknown, np.uint32))
                read[at[i]] = -1
            many[i] = len(made[-1])
        out = np.repeat(ids, many).astype(np.uint32)
        if made:
            out[np.repeat(flat == FALLBACK, many)] = np.concatenate(made)
        wrong = np.concatenate([[0], np.cumsum(read != code)])
        return out, np.bincount(row, weights=many, minlength=len(count)).astype(np.int64), wrong[first + length] == wrong[first]

    def _spans(self, raw: np.ndarray, edges: np.ndarray, before: int) -> np.ndarray:
        """Starts of the inputs of normalised bytes (rows start at ``edges``; ``before`` is the byte in front)."""
        space, line = raw == 0x20, raw == 0x0A
        was_space, was_line = np.concatenate([[before == 0x20], space[:-1]]), np.concatenate([[before == 0x0A], line[:-1]])
        begin = np.zeros(len(raw), bool)
        if self.by_word:
            begin |= space & ~was_space
            if self.by_line:
                begin |= line != was_line
                begin &= ~(space & was_space)
        begin[edges] = True
        return np.flatnonzero(begin)

    def encode_column(self, column: pa.Array) -> Iterator[tuple[list[np.ndarray], bool]]:
        """For each text its ids, in parts, and whether decoding them gives it back; bytes are read in windows."""
        column, same = self.normaliser.column(column)
        raw, offsets, _ = buffers(column)
        n, row, lo, parts, good = len(offsets) - 1, 0, 0, [], True
        while lo < len(raw):
            hi = self._window(raw, offsets, lo)
            edges = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "left")] - lo
            starts = self._spans(raw[lo:hi], np.append(edges, 0), 0)
            buf = np.zeros(hi - lo + 2 * PAD, dtype=np.uint8)
            buf[PAD : PAD + hi - lo] = raw[lo:hi]
            at = self.table.find(buf, starts, np.append(starts[1:], hi - lo))
            ids, stop = self.table.ids_of(at)
            stop = np.concatenate([[0], stop])
            wrong = np.concatenate([[0], np.cumsum(~self.table.flag[at])])
            while row < n and (offsets[row] < hi or offsets[row + 1] <= hi):
                i, j = np.searchsorted(starts, [max(offsets[row], lo) - lo, min(offsets[row + 1], hi) - lo], "left").tolist()
                parts.append(ids[stop[i] : stop[j]])
                good = good and bool(wrong[i] == wrong[j])
                if offsets[row + 1] > hi:
                    break
                yield parts, good and bool(same[row])
                row, parts, good = row + 1, [], True
            lo = hi
        for i in range(row, n):
            yield [np.zeros(0, np.uint32)], bool(same[i])

    def _window(self, raw: np.ndarray, offsets: np.ndarray, lo: int) -> int:
        """The end of a window from ``lo``: a row's end, or an input's start in a long row."""
        hi = lo + WINDOW
        if hi >= len(raw):
            return len(raw)
        row_end = int(offsets[np.searchsorted(offsets, hi, "left")])
        while hi < row_end:
            starts = self._spans(raw[hi : min(hi + 65536, row_end)], np.zeros(0, np.int64), int(raw[hi - 1]))
            if len(starts):
                return hi + int(starts[0])
            hi = min(hi + 65536, row_end)
        return row_end

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [np.concatenate(parts).tolist() for parts, _ in self.encode_column(pa.array(texts, pa.string()))]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def _joined(self, ids: list[int]) -> str:
        """Pieces joined, runs of byte ids read as UTF-8."""
        pieces, kinds = self.spec.pieces, self.spec.kinds
        parts, run = [], bytearray()
        for i in ids:
            if kinds[i] == BYTE:
                run.append(int(pieces[i][1:-1], 16))
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if kinds[i] == UNKNOWN:
                parts.append(" \u2047 ")
            elif kinds[i] != CONTROL:
                parts.append(pieces[i])
        if run:
            parts.append(run.decode("utf-8", "replace"))
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The inverse machine: pieces joined, runs of byte ids read as UTF-8, marks back to spaces, the front mark (of models that squeeze spaces, all in front) dropped."""
        out = self._joined(ids).replace(MARK, " ")
        if self.spec.squeeze:
            return out.lstrip(" ")
        return out[1:] if self.spec.dummy_prefix and out.startswith(" ") else out


class _Merges:
    """The merge machine's arcs, worked out for many pairs of pieces at once when a composition asks for them.

    Take the pieces s and t apart in the reverse of the order in which they were merged.  Whatever stands on both sides of the
    border in between must not form a piece that merging would have preferred to what it did next there.  This holds for pieces whose parts
    always score better than they do (as in trained models); pairs with other pieces are merged out.
    """

    def __init__(self, fst: PieceFst) -> None:
        self.fst, spec = fst, fst.spec
        n = len(spec.pieces)
        _, self.rank = np.unique(-np.array(spec.scores), return_inverse=True)  # 0 is merged first
        self.rank = self.rank.astype(np.int64) + 1
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        self.whole, self.plain = np.zeros(n, bool), np.zeros(n, bool)
        pairs, joins = [], []
        for p, i in sorted(fst.id.items(), key=lambda x: len(x[0])):
            if len(p) == 1:
                self.rank[i], self.whole[i], self.plain[i] = 0, True, True
                continue
            for cut in range(1, len(p)):
                a, b = fst.id.get(p[:cut]), fst.id.get(p[cut:])
                if a is not None and b is not None:
                    pairs.append(a * n + b)
                    joins.append(i)
            got = fst._merge(p)
            if len(got) == 1:
                self.whole[i] = True
                a, b = fst.id.get(got[0][1], -1), fst.id.get(got[0][2], -1)
                self.left[i], self.right[i] = a, b
                # a letter without a piece of its own has no number: such pieces are merged out
                self.plain[i] = a >= 0 and b >= 0 and self.plain[a] and self.plain[b] and max(self.rank[a], self.rank[b]) < self.rank[i]
        self.n, self.joins = n, np.array(joins, dtype=np.int64)
        self.pairs = Slots(1, max(16, len(pairs)))
        self.pairs.add(mix(np.array(pairs, dtype=U64))[None])

    def open(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether each piece t may follow the piece s before it (-1: nothing)."""
        out = self.whole[t] & ((s < 0) | self.whole[np.maximum(s, 0)])
        live = np.flatnonzero(out & (s >= 0))
        hard = live[~(self.plain[s[live]] & self.plain[t[live]])]
        pieces = self.fst.spec.pieces
        for i in hard.tolist():
            out[i] = self.fst.merged(pieces[s[i]] + pieces[t[i]]) == [pieces[s[i]], pieces[t[i]]]
        live = np.setdiff1d(live, hard, assume_unique=True) if len(hard) else live
        a, b, limit = s[live], t[live], np.full(len(live), 2 * self.n + 2)
        while len(live):
            found = self.pairs.find(mix((a * self.n + b).astype(U64))[None])
            # doubled ranks: the next merge was one of the right side's (odd) or of the left side's (even); of equals the left comes first
            shut = (found >= 0) & (2 * self.rank[self.joins[found]] < limit) if len(self.joins) else np.zeros(len(live), bool)
            out[live[shut]] = False
            done = (self.rank[a] == 0) & (self.rank[b] == 0)
            go = ~(shut | done)
            live, a, b = live[go], a[go], b[go]
            of_left = self.rank[a] > self.rank[b]
            limit = np.where(of_left, 2 * self.rank[a], 2 * self.rank[b] + 1)
            a, b = np.where(of_left, self.right[a], a), np.where(of_left, b, self.left[b])
        return out


_machines: dict[str, PieceFst] = {}


def machine(path: str) -> PieceFst:
    """The machine of this Python process for a file."""
    if path not in _machines:
        _machines[path] = PieceFst(read_model(path))
    return _machines[path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), round_trip, and on request ids, for each row of ``docs``.

    A null text counts as empty and has no ids.  ``round_trip``: decoding the ids gives the text back (a text that itself holds
    U+2581 decodes to spaces there).  Repeated rows are encoded one by one, texts of any length whole.
    """
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = machine(model_path)
        for batch in batches:
            all_ids, size, crc, same = [], [], [], []
            for parts, good in fst.encode_column(batch.column(1)):
                n = c = 0
                for part in parts:
                    n, c = n + len(part), zlib.crc32(part.astype("<u4", copy=False).data, c)
                size.append(n)
                crc.append(c)
                same.append(good)
                if with_ids:
                    all_ids.append(np.concatenate(parts).astype(np.int32))
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            names = ["doc_id", "n_ids", "ids_crc32", "round_trip"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_ids long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)

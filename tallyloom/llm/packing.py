"""Packing documents into fixed windows, keeping their order, by dynamic programming.

Tokens of the documents stand in one line, each document closed by an end id.  A plan cuts the line into windows of at
most ``size`` tokens.  Windows may end behind any document, at a price behind a sentence, and at a higher price
every 16 tokens of a stretch without boundaries.  With boundary positions x_0 < x_1 < ...,

    cost(i) = min over j with x_i - x_j <= size of cost(j) + (size - (x_i - x_j)) + price(i)

so ``cost(j) + x_j`` is what a window's start is chosen by, and a monotone queue gives its sliding minimum in
amortised constant time.  Each task plans its own rows in blocks of about ``BLOCK_TOKENS``; what follows a block's last cut
opens the next block, at no cost.  What is left at the task's end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows
from tallyloom.llm.spans import PAD, SpanTable, gathered
from tallyloom.llm.textops import FOLD, SEPARATOR, blocks, buffers

SIZE = 4096
END_ID = 2
BLOCK_TOKENS = 1 << 18
SENTENCE_PRICE = 2
FORCED_PRICE = 6
TOKEN_BLOCK = 1 << 20
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

FREE, SENTENCE, FORCED = 0, 1, 2


class WordTokens:
    """Ids of whole texts by way of a table of their words.

    Valid for a tokenizer that neither merges nor looks across ASCII white space (which it drops) and that folds A-Z: a
    text's ids are then its words' ids in a row.  New words of Latin letters go through a ranked merge table made from the same file, where it
    has the form for it (``_ranked``); all others through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = _ranked(path)
        self.table = SpanTable(self._learn)

    def _learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, how many each has, and whether it may end a sentence."""
        last = buf[ends - 1 + PAD]
        ending = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
        for i in np.flatnonzero(_WIDE_LAST[last] & (ends - starts >= 3)).tolist():
            ending[i] = buf[ends[i] - 3 + PAD : ends[i] + PAD].tobytes() in _WIDE_STOPS
        plain = _plain(*gathered(buf, starts, ends, 0x20)) if self.ranked else np.zeros(len(starts), bool)
        parts, counts = [], []
        if plain.any():
            ids, stops = self.ranked.words(*gathered(buf, starts[plain], ends[plain], 0x20))
            parts.append(ids)
            counts.append(np.diff(stops, prepend=0))
        others = np.flatnonzero(~plain)
        for lo in range(0, len(others), 4096):
            some = [buf[starts[i] + PAD : ends[i] + PAD].tobytes().decode("utf-8", "replace") for i in others[lo : lo + 4096].tolist()]
            for e in self.tokenizer.encode_batch(some, add_special_tokens=False):
                parts.append(np.array(e.ids, dtype=np.uint32))
                counts.append([len(e.ids)])
        order = np.concatenate([np.flatnonzero(plain), others])
        got, flat = np.concatenate(counts).astype(np.int64), np.concatenate(parts).astype(np.uint32)
        if len(got) != len(order):
            raise RuntimeError("a word was lost in tokenizing")
        lo, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        lo[order], count[order] = np.cumsum(got) - got, got
        stop = np.cumsum(count)
        return flat[np.arange(len(flat)) + np.repeat(lo - stop + count, count)], count, ending

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and the positions behind its sentences; raw bytes are read in blocks, so long texts cost their ids only."""
        row, parts, sentences, done = 0, [], [], 0
        n = len(offsets) - 1
        for lo, hi in blocks(raw, offsets, TOKEN_BLOCK):
            buf = np.zeros(hi - lo + 2 * PAD, dtype=np.uint8)
            buf[PAD : PAD + hi - lo] = FOLD[raw[lo:hi]]
            starts, ends = word_spans(buf[PAD : PAD + hi - lo], offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "left")] - lo)
            at = self.table.find(buf, starts, ends)
            ids, stop = self.table.ids_of(at)
            stop = np.concatenate([[0], stop])
            closing = stop[1:][self.table.flag[at]]
            while row < n and (offsets[row] < hi or offsets[row + 1] <= hi):
                a, b = stop[np.searchsorted(starts, [max(offsets[row], lo) - lo, min(offsets[row + 1], hi) - lo], "left")].tolist()
                parts.append(ids[a:b])
                i, j = np.searchsorted(closing, [a, b], "right")
                sentences.append(closing[i:j] - a + done)
                done += b - a
                if offsets[row + 1] > hi:
                    break
                yield np.concatenate(parts), np.concatenate(sentences)
                row, parts, sentences, done = row + 1, [], [], 0
        for _ in range(row, n):
            yield np.zeros(0, np.uint32), np.zeros(0, np.int64)


def word_spans(piece: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, in which rows start at ``edges``."""
    inside = ~SEPARATOR[piece]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = edges[(edges > 0) & (edges < len(piece))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _plain(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the words of ``text`` (each followed by a space; they start at ``at``) hold only U+0021..U+007E and U+00A1..U+024F without "<".

    NFC leaves such words alone and lower case is by character.
    """
    lead, follows = (text >= 0xC2) & (text <= 0xC9), (text & 0xC0) == 0x80
    bad = (text < 0x20) | (text == 0x3C) | (text == 0x7F) | (text >= 0xCA) | (text == 0xC0) | (text == 0xC1)
    bad[1:] |= follows[1:] != lead[:-1]
    bad[0] |= follows[0]
    bad[1:] |= ((text[:-1] == 0xC2) & (text[1:] == 0xA0)) | ((text[:-1] == 0xC2) & (text[1:] < 0xA0)) | ((text[:-1] == 0xC9) & (text[1:] > 0x8F))
    return np.add.reduceat(bad, at, dtype=np.int64) == 0


_tables: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The table of this Python process for a file: tasks that run one after another share it."""
    if path not in _tables:
        _tables[path] = WordTokens(path)
    return _tables[path]


_WIDE_STOPS = ("。".encode(), "！".encode(), "？".encode())
_WIDE_LAST = np.zeros(256, dtype=bool)
_WIDE_LAST[[w[-1] for w in _WIDE_STOPS]] = True


class _Ranked:
    """The same merges as ranks of byte strings; a word's end is the byte 1, which joins its last byte first."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        import regex
        import tiktoken

        table, more = {}, 0
        for b in range(256):  # printable bytes stand for themselves, the others for code points from 256 on
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
                table[chr(b)] = b
            else:
                table[chr(256 + more)] = b
                more += 1
        raw = lambda token: bytes(table[c] for c in token.removesuffix("</w>")) + b"\x01" * token.endswith("</w>")
        ranks: dict[bytes, int] = {bytes([b, 1]): b for b in range(256)}
        for pair in merges:
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            ranks[raw(a) + raw(b)] = len(ranks)
        if len(ranks) != 256 + len(merges):
            raise ValueError("merges give a token twice")
        for b in range(256):
            ranks.setdefault(bytes([b]), len(ranks))
        self.to_id = np.zeros(len(ranks), np.uint32)
        for token, i in vocab.items():
            if (r := ranks.get(raw(token))) is not None:
                self.to_id[r] = i
        self.space = ranks[b" "]
        self.mark = regex.compile(self.PATTERN)
        self.core = tiktoken.Encoding("ranked", pat_str=r"[^\x01 ]+\x01| ", mergeable_ranks=ranks, special_tokens={})

    def words(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (UTF-8, each followed by a single space, starting at ``at``), and the positions behind each."""
        marked = self.mark.sub("\\g<0>\x01", text.tobytes().decode().lower())
        got = np.array(self.core.encode_ordinary(marked), dtype=np.int64)
        gaps = np.flatnonzero(got == self.space)
        return self.to_id[np.delete(got, gaps)], gaps - np.arange(len(gaps))


def _ranked(path: str) -> _Ranked | None:
    """A merge table if the file is a lower-casing byte-level BPE with word ends of the known form; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    split = json.dumps(spec.get("pre_tokenizer") or {})
    known = json.dumps("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+") in split
    lower = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    if model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and known and lower:
        return _Ranked(model["vocab"], model["merges"])
    return None


def plan(bounds: np.ndarray, kinds: np.ndarray, size: int) -> list[int]:
    """Cut positions (rising) of least cost, the line's end left out; ``bounds`` rise from above 0 and end with it.

    Gaps between bounds are at most ``size``.  What follows the last cut fits a window and costs nothing: it opens the next block, or is
    cut where no padding is needed.
    """
    price = (0.0, float(SENTENCE_PRICE), float(FORCED_PRICE))
    xs, ks = [0, *bounds.tolist()], [FREE, *kinds.tolist()]
    cost, came = [0.0] * len(xs), [0] * len(xs)
    queue: deque[int] = deque([0])
    key = [0.0] * len(xs)
    for i in range(1, len(xs)):
        x = xs[i]
        while x - xs[queue[0]] > size:
            queue.popleft()
        j = queue[0]
        cost[i] = c = key[j] + size - x + price[ks[i]]
        came[i] = j
        key[i] = k = c + x
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(i)
    at = [i for i in range(len(xs) - 1) if xs[-1] - xs[i] <= size]
    i, cuts = min(at, key=lambda i: (cost[i], i)), []
    while i:
        cuts.append(xs[i])
        i = came[i]
    return cuts[::-1]


def with_forced(bounds: np.ndarray, kinds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Add cuts inside of gaps wider than a small part of a window, so that a plan exists and windows can be full."""
    step = max(1, size // 256)
    before = np.concatenate([[0], bounds[:-1]])
    count = np.maximum(0, (bounds - before - 1) // step)
    total = int(count.sum())
    if not total:
        return bounds, kinds
    nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + 1
    xs = np.concatenate([bounds, np.repeat(before, count) + nth * step])
    ks = np.concatenate([kinds, np.full(total, FORCED)])
    order = np.argsort(xs, kind="stable")
    return xs[order], ks[order]


class Packer:
    """Takes documents in order, gives rows of pieces."""

    def __init__(self, size: int, end_id: int, first_sequence: int) -> None:
        self.size, self.end_id, self.sequence = size, end_id, first_sequence
        self.docs: list[tuple[int | None, int, int, np.ndarray, np.ndarray, int]] = []  # id, start, first, ids, sentence ends, all tokens
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        whole = np.append(ids, np.uint32(self.end_id))
        ends = sentences[sentences < len(whole) - 1]
        self.docs.append((doc_id, 0, self.waiting, whole, ends, len(whole)))
        self.waiting += len(whole)
        if self.waiting >= max(BLOCK_TOKENS, 4 * self.size):
            yield from self._flush(False)

    def close(self) -> Iterator[tuple]:
        if self.waiting:
            yield from self._flush(True)

    def _flush(self, last: bool) -> Iterator[tuple]:
        xs = [np.append(first + ends, first + len(ids)) for _, _, first, ids, ends, _ in self.docs]
        ks = [np.append(np.full(len(ends), SENTENCE), FREE) for _, _, _, _, ends, _ in self.docs]
        bounds, kinds = with_forced(*self._distinct(np.concatenate(xs), np.concatenate(ks)), self.size)
        cuts = plan(bounds, kinds, self.size)
        if last:  # the rest: powers of two, largest first
            lo, rest = cuts[-1] if cuts else 0, self.waiting - (cuts[-1] if cuts else 0)
            for j in range(rest.bit_length() - 1, -1, -1):
                if rest >> j & 1:
                    lo += 1 << j
                    cuts.append(lo)
        if cuts:
            yield from self._emit(cuts)
            self._drop(cuts[-1])

    @staticmethod
    def _distinct(xs: np.ndarray, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.append(xs[1:] > xs[:-1], True) if len(xs) else np.zeros(0, bool)
        keep &= xs > 0
        return xs[keep], ks[keep]

    def _emit(self, cuts: list[int]) -> Iterator[tuple]:
        k, lo = 0, 0
        for doc_id, start, first, ids, _, total in self.docs:
            at, end = first, first + len(ids)
            while at < end and k < len(cuts):
                stop = min(end, cuts[k])
                part = ids[at - first : stop - first]
                yield doc_id, start + at - first, stop - at, zlib.crc32(part.astype("<u4", copy=False).data), total, self.sequence + k, at - lo
                at = stop
                if at == cuts[k]:
                    lo = at
                    k += 1
        self.sequence += len(cuts)

    def _drop(self, cut: int) -> None:
        left = []
        for doc_id, start, first, ids, ends, total in self.docs:
            if first + len(ids) <= cut:
                continue
            gone = max(0, cut - first)
            left.append((doc_id, start + gone, max(0, first - cut), ids[gone:], ends[ends > gone] - gone, total))
        self.docs = left
        self.waiting = sum(len(x[3]) for x in left)


def _packed(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64()) for c in COLUMNS.split(", ")])
        tokens, packer = word_tokens(path), Packer(size, end_id, TaskContext.get().partitionId() << 40)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

        for batch in batches:
            raw, offsets, _ = buffers(batch.column(1))
            rows = []
            for doc_id, (ids, ends) in zip(batch.column(0).to_pylist(), tokens.encode(raw, offsets), strict=True):
                rows += packer.add(doc_id, ids, ends)
            if rows:
                yield out(rows)
        if rows := list(packer.close()):
            yield out(rows)

    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Rows are packed in the order of their input partitions, so nothing is shuffled; each row with its ``end_id`` lies in
    consecutive pieces.  A null or empty text is its end id alone.  Rows that repeat an id, or have none, are packed like others.
    Sequences are full, a few tokens short (a window ends at a sentence), or a power of two long.  An empty table gives no rows.
    """
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_packed(tokenizer_path, size, end_id), COLUMNS)

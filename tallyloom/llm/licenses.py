"""License scan: lines, paragraphs and whole texts against license templates by Dice coefficient over word bigrams.

Text is normalised: A-Z lower-cased, ASCII punctuation to spaces, runs of white space to one.  A unit (a line; a paragraph of several
lines; a text of several paragraphs) with bigram multiset A matches template B if 2 |A & B| / (|A| + |B|) reaches the
threshold t.  Since |A & B| <= min(|A|, |B|), only templates with t / (2 - t) <= |A| / |B| <= (2 - t) / t can match; and
as many of A's bigrams must be in the templates' vocabulary, which drops almost all units before any set is built.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows
from tallyloom.llm.textops import U64, buffers, mix, words

THRESHOLD = 0.85

#: Texts of public licenses and of the notices by which works refer to them.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-2-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "ISC": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32
_FOLD[[9, 11, 12, 13]] = 32
UNITS = ("line", "paragraph", "text")
SCHEMA = "doc_id long, unit string, unit_no long, license string, template int, dice double, n_bigrams long"


def _bigrams(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else np.zeros(0, U64)


class Templates:
    def __init__(self, templates: dict[str, list[str]]) -> None:
        texts = [(name, i, t) for name in sorted(templates) for i, t in enumerate(templates[name])]
        self.names = [(name, i) for name, i, _ in texts]
        self.bags: list[Counter] = []
        for _, _, t in texts:
            raw = _FOLD[np.frombuffer(t.encode(), np.uint8)]
            self.bags.append(Counter(_bigrams(words(raw, np.array([0, len(raw)]))[0]).tolist()))
        self.sizes = np.array([sum(b.values()) for b in self.bags])
        self.vocabulary = np.array(sorted({x for b in self.bags for x in b}), dtype=U64)

    def known(self, grams: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, grams)
        at[at == len(self.vocabulary)] = 0
        return self.vocabulary[at] == grams

    def best(self, grams: np.ndarray, threshold: float) -> tuple[int, float] | None:
        """The template of highest Dice coefficient at ``threshold`` or more; the first of equals."""
        n, bag, found = len(grams), Counter(grams.tolist()), None
        ratio = threshold / (2 - threshold)
        for k in np.flatnonzero((self.sizes * ratio <= n + 1e-9) & (n * ratio <= self.sizes + 1e-9)):
            other = self.bags[k]
            dice = 2 * sum(min(c, other[x]) for x, c in bag.items() if x in other) / (n + int(self.sizes[k]))
            if dice >= threshold and (found is None or dice > found[1]):
                found = (int(k), dice)
        return found


def _units(raw: np.ndarray, first: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each kind of unit the number of every word's unit within the whole batch, rising."""
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, first)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    new_row = np.concatenate([[0], (np.diff(row) > 0).astype(np.int64)])[: len(row)]
    step = np.diff(line, prepend=line[:1])
    lines = np.cumsum((step > 0) | (new_row > 0))
    # a line without words between two lines parts paragraphs
    paragraphs = np.cumsum((step > 1) | (new_row > 0))
    return [lines, paragraphs, row]


def _scan(templates: dict[str, list[str]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates)
        for batch in batches:
            source, offsets, _ = buffers(batch.column(1))
            raw = _FOLD[source]
            h, bounds, first = words(raw, offsets, positions=True)
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            if len(h) > 1:
                grams = _bigrams(h)
                hit = known.known(grams)
                kinds = _units(raw, first, bounds)
                row = kinds[2]
                for u, unit in enumerate(kinds):
                    starts = np.flatnonzero(np.diff(unit, prepend=-1))
                    ends = np.append(starts[1:], len(unit))
                    inside = np.append(unit[1:] == unit[:-1], False)
                    hits = np.add.reduceat((hit & inside[:-1]).astype(np.int64), np.minimum(starts, len(grams) - 1)) if len(grams) else np.zeros(len(starts))
                    size = ends - starts - 1
                    hits[starts > len(grams) - 1] = 0
                    possible = (size > 0) & (hits * (2 - threshold) + 1e-9 >= size * threshold)
                    if u:  # only units of several smaller units
                        possible &= kinds[u - 1][ends - 1] > kinds[u - 1][starts]
                    row_first = unit[bounds[row[starts]]]
                    for s in np.flatnonzero(possible):
                        found = known.best(grams[starts[s] : ends[s] - 1], threshold)
                        if found:
                            name, number = known.names[found[0]]
                            out.append((ids[row[starts[s]]], UNITS[u], int(unit[starts[s]] - row_first[s]) if u < 2 else 0, name, number, found[1], int(size[s])))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2], pa.int64()), pa.array(columns[3]), pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.float64()), pa.array(columns[6], pa.int64())],
                    names=["doc_id", "unit", "unit_no", "license", "template", "dice", "n_bigrams"],
                )

    return run


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per matching unit: doc_id, unit, unit_no, license, template, dice, n_bigrams.

    ``unit_no`` counts a document's units of that kind that hold words, from 0.  A paragraph is reported only if it has several lines with
    words, a whole text only if it has several paragraphs.  Of several templates the one of the highest coefficient is given,
    of equals the first by name.  Units of fewer than two words, null and empty texts match nothing.  Repeated rows are scanned one by
    one; long texts are scanned whole.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan(templates or TEMPLATES, threshold), SCHEMA)

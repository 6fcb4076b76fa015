"""Quality classifier: naive-Bayes support vectors.

Features are indicators of hashed byte n-grams of the whole text and of n-grams of word shapes (letter case, punctuation at the end,
equality with an earlier word).  Each is scaled by the log ratio of its frequencies in the two
classes; a linear hinge-loss model over unit-length rows is fitted by dual coordinate descent; margins of
cross-fitted folds calibrate a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyloom.llm.common import arrow_rows, free_name
from tallyloom.llm.ngrams import hashed, text_blocks
from tallyloom.llm.textops import SEPARATOR, U64, buffers, mix, words

BITS = 18
ORDERS = (3, 4)
SHAPE_BITS = 12
WIDTH = (1 << BITS) * len(ORDERS) + (1 << SHAPE_BITS)
TRAIN_DOCS = 4000


def _shape_grams(h: np.ndarray, raw_first: np.ndarray, raw_second: np.ndarray, raw_last: np.ndarray) -> np.ndarray:
    """Buckets of 1- to 3-grams of word shapes."""
    n = len(h)
    kind = _CLASS[raw_first] * 25 + _CLASS[raw_second] * 5 + _CLASS[raw_last]
    same = np.zeros(n, np.int64)
    same[1:] |= h[1:] == h[:-1]
    same[2:] |= (h[2:] == h[:-2]).astype(np.int64) * 2
    code = (kind * 4 + same).astype(U64)
    out = [mix(code + U64(1))]
    if n > 1:
        out.append(mix(code[1:] * U64(1009) + code[:-1] + U64(7919 << 20)))
    if n > 2:
        out.append(mix((code[2:] * U64(1009) + code[1:-1]) * U64(1009) + code[:-2] + U64(104729 << 20)))
    return (np.concatenate(out) >> U64(64 - SHAPE_BITS)).astype(np.int64)


_CLASS = np.full(256, 4, dtype=np.int64)  # other
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[128:] = 3


class Features:
    """Distinct feature numbers of each row of a text column."""

    def __init__(self) -> None:
        self.seen = np.zeros(WIDTH, dtype=bool)

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        raw, offsets, _ = buffers(column)
        h, bounds = words(raw, offsets)
        inside = ~SEPARATOR[raw] if len(raw) else np.zeros(0, bool)
        begin = inside.copy()
        if len(raw):
            begin[1:] &= ~inside[:-1]
            edges = offsets[:-1][offsets[:-1] < len(raw)]
            begin[edges] |= inside[edges]
        starts = np.flatnonzero(begin)
        stop = inside.copy()
        if len(raw):
            stop[:-1] &= ~inside[1:]
            edges = offsets[1:][offsets[1:] > 0] - 1
            stop[edges] |= inside[edges]
        ends = np.flatnonzero(stop)
        found: list[np.ndarray] = []
        for i, piece, last in text_blocks(raw, offsets, max(ORDERS) - 1):
            for j, order in enumerate(ORDERS):
                found.append(self._new(hashed(piece, order, BITS, False) + (j << BITS)))
            if last:
                a, b = bounds[i], bounds[i + 1]
                if b > a:
                    first, end = starts[a:b], ends[a:b]
                    shapes = _shape_grams(h[a:b], raw[first], raw[np.minimum(first + 1, end)], raw[end])
                    found.append(self._new(shapes + (len(ORDERS) << BITS)))
                out = np.concatenate(found)
                self.seen[out] = False
                found = []
                yield out

    def _new(self, numbers: np.ndarray) -> np.ndarray:
        numbers = numbers[~self.seen[numbers]]
        slot = _slots()
        at = np.arange(len(numbers), dtype=np.int32)
        slot[numbers] = at
        numbers = numbers[slot[numbers] == at]
        self.seen[numbers] = True
        return numbers


_slot: list[np.ndarray] = []


def _slots() -> np.ndarray:
    if not _slot:
        _slot.append(np.zeros(WIDTH, dtype=np.int32))
    return _slot[0]


@dataclass
class Model:
    """score = sigmoid(slope * (w . x / |x| + bias) + offset); w already holds the log ratios."""

    w: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float

    def margin(self, numbers: np.ndarray) -> float:
        if not len(numbers):
            return float(self.w[-1])
        length = float(np.sqrt(self.scale[numbers].astype(np.float64).sum())) or 1.0
        return float(self.w[numbers].astype(np.float64).sum()) / length + float(self.w[-1])

    def score(self, numbers: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(numbers) + self.offset, -500, 500))))


@dataclass
class Rows:
    """Feature numbers of many rows in one flat array; row i is flat[at[i] : at[i + 1]]."""

    flat: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64))

    def __len__(self) -> int:
        return len(self.at) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.at[i] : self.at[i + 1]]


def fit_svm(rows: Rows, chosen: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 15, alpha: float = 1.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights over WIDTH features and a bias, and squared log ratios, by dual coordinate descent on the hinge loss over the chosen rows."""
    p, q = np.full(WIDTH, alpha), np.full(WIDTH, alpha)
    for i in chosen:
        (p if y[i] > 0 else q)[rows[i]] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    values = ratio.astype(np.float32)[rows.flat]
    for i in chosen:
        v = values[rows.at[i] : rows.at[i + 1]]
        v /= np.sqrt(v @ v) or 1.0
    w, bias = np.zeros(WIDTH), 0.0
    dual = np.zeros(len(rows))
    # classes weigh alike in total
    n_pos = max(1, int((y[chosen] > 0).sum()))
    n_neg = max(1, len(chosen) - n_pos)
    limit = np.where(y > 0, c * len(chosen) / (2 * n_pos), c * len(chosen) / (2 * n_neg))
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(chosen):
            row, v = rows[i], values[rows.at[i] : rows.at[i + 1]]
            gradient = y[i] * (w[row] @ v + bias) - 1
            new = min(max(dual[i] - gradient / (float(v @ v) + 1.0), 0.0), limit[i])
            step = new - dual[i]
            if step:
                dual[i] = new
                w[row] += (step * y[i]) * v
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return np.append(w * ratio, bias).astype(np.float32), np.append(ratio * ratio, 0).astype(np.float32)


def fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's calibration, by Newton steps."""
    n_pos, n_neg = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    s, t = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(s * margin + t, -30, 30)))
        d, r = p - target, p * (1 - p) + 1e-9
        gs, gt = (d * margin).sum() + 1e-3 * s, d.sum()
        hss, hst, htt = (r * margin * margin).sum() + 1e-3, (r * margin).sum(), r.sum()
        det = hss * htt - hst * hst
        ds, dt = (htt * gs - hst * gt) / det, (hss * gt - hst * gs) / det
        s, t = s - float(np.clip(ds, -5, 5)), t - float(np.clip(dt, -5, 5))
        if abs(ds) + abs(dt) < 1e-7:
            break
    return max(s, 1e-6), t


def fit(rows: list[np.ndarray] | Rows, labels: np.ndarray) -> Model | None:
    """A calibrated model; None unless both labels occur."""
    rows = rows if isinstance(rows, Rows) else Rows.of(rows)
    y = np.where(labels == 1, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        return None
    part, every = np.arange(len(rows)) % 2, np.arange(len(rows))
    margins = np.zeros(len(rows))
    for k in (0, 1):
        inn, out = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if len(set(y[inn].tolist())) < 2:
            inn = every
        w, scale = fit_svm(rows, inn, y)
        half = Model(w, scale, 1.0, 0.0)
        margins[out] = [half.margin(rows[i]) for i in out]
    slope, offset = fit_sigmoid(margins, y)
    w, scale = fit_svm(rows, every, y)
    return Model(w, scale, slope, offset)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = Features()
    for batch in batches:
        rows = [x.astype(np.int32) for x in make.rows(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "label", "features"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> Model | None:
    """Fit on the ``max_docs`` labelled documents whose ids hash lowest (a bounded sample of the given rows).

    Of rows that repeat an id the text that hashes lowest counts (a null text as empty), of labels the greatest.
    """
    arrow_rows(docs.sparkSession)
    one = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = texts.select("doc_id", "label", "text").mapInArrow(_features, "doc_id long, label int, features array<int>").toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    parts = got["features"].combine_chunks()
    parts = pa.concat_arrays(parts.chunks) if isinstance(parts, pa.ChunkedArray) else parts
    at = parts.offsets.to_numpy()
    flat = parts.values.to_numpy()
    rows = Rows.of([flat[at[i] : at[i + 1]] for i in order])
    labels_of = got["label"].to_numpy()[order]
    del got, parts, flat
    model = fit(rows, labels_of)
    pa.default_memory_pool().release_unused()
    return model


def _scored(shared, text_at: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, make = shared.value, Features()
        for batch in batches:
            scores = [0.5 if model is None else model.score(x) for x in make.rows(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return run


def score(docs: DataFrame, model: Model | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0..1) under ``name``, without a shuffle; a null text counts as empty, no model gives 0.5."""
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = StructType([*rows.schema.fields, StructField(name, DoubleType())])
    return rows.mapInArrow(_scored(spark.sparkContext.broadcast(model), rows.columns.index(text_col), name), schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_docs: int = TRAIN_DOCS, held_out=None) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= threshold) for each row of ``docs``.

    ``held_out``: a Column over doc_id; labels of those rows are not learned from.  Only the text is scored.
    Of labels that repeat an id the greatest counts; labels other than 0 and 1 are passed over.
    """
    test = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    known = labels.select("doc_id", "quality").where(~test)
    rows = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, known, max_docs))
    return rows.select("doc_id", test.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns, whatever the names of these."""
    name = free_name(docs, "__score")
    return score(docs, train(docs, labels, max_docs), name=name).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's hidden vector is the mean of the embeddings of all its hashed byte n-grams (case folded; of letters and spaces); a softmax layer gives the
languages.  Both layers are trained by stochastic gradient descent in numpy on a bounded sample of labelled
documents.  As the mean is linear, embeddings and softmax weights fold into one table of logits per
bucket for prediction.  A temperature is fitted on documents held back from training.  How well a text is known is the
mean log-frequency of its n-grams among those trained on; a document is rejected if that is below a low quantile of the
documents held back by more than a quarter of what lies between this and their median, and by more than chance explains at its length.
The probability cannot say this: it only shares out 1 among the languages learned, so it is low for a
mixture of them and may be high for a text in none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tallyloom.llm.common import arrow_rows, free_name
from tallyloom.llm.ngrams import hashed, text_blocks
from tallyloom.llm.textops import SEPARATOR, buffers

BITS = 16
ORDERS = (2, 3, 4)
DIM = 16
TRAIN_DOCS = 2000
UNKNOWN = "und"
REJECT_QUANTILE = 0.001
REJECT_SLACK = 0.25
REJECT_CHANCE = 3.0

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = True
_LETTER[97:123] = True


#: what an n-gram may hold: letters, bytes beyond ASCII, white space
_KEEP = _LETTER | SEPARATOR
_KEEP[128:] = True


def grams(piece: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams without digits and ASCII punctuation: numbers, secrets and marks tell no language."""
    keep = _KEEP[piece]
    out, fine = [], keep
    for order in range(2, max(ORDERS) + 1):
        fine = fine[:-1] & keep[order - 1 :]
        if order in ORDERS:
            out.append(hashed(piece, order, BITS, True)[fine[: max(0, len(piece) - order + 1)]])
    return np.concatenate(out)


def has_letter(piece: np.ndarray) -> bool:
    """Whether the UTF-8 bytes hold a letter of any script."""
    if _LETTER[piece].any():
        return True
    if not len(piece) or piece.max() < 128:
        return False
    return any(c.isalpha() for c in piece[piece >= 128].tobytes().decode("utf-8", "ignore"))


@dataclass
class Model:
    """Logits of bucket k: table[k]; of a text: their mean plus bias, times heat.  known[k]: log-frequency of bucket k."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float = 1.0
    known: np.ndarray | None = None
    reject: float = -np.inf
    scatter: float = 0.0

    def rejects(self, known: float, count: int) -> bool:
        """Whether a text of ``count`` n-grams of the mean log-frequency ``known`` is too strange; neighbours overlap, so about one in nine is evidence of its own.  Without n-grams there is none."""
        return count > 0 and known + REJECT_CHANCE * self.scatter / np.sqrt(count / 9) < self.reject

    def probabilities(self, total: np.ndarray, count: int) -> np.ndarray:
        z = (total / max(count, 1) + self.bias) * self.heat
        e = np.exp(z - z.max())
        return e / e.sum()


Row = tuple[np.ndarray, np.ndarray]  #: distinct buckets of a text, and how often each occurs


def sgd(rows: list[Row], y: np.ndarray, langs: list[str], epochs: int = 12, rate: float = 0.5, seed: int = 11) -> Model:
    """Train embeddings and softmax one document at a time, the rate falling linearly to 0."""
    draw = np.random.default_rng(seed)
    n_lang = len(langs)
    emb = draw.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, n_lang), np.float32), np.zeros(n_lang, np.float32)
    steps, at = max(1, epochs * len(rows)), 0
    shares = [(numbers, (times / max(1, times.sum())).astype(np.float32)) for numbers, times in rows]
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            (numbers, share), lr = shares[i], rate * (1 - at / steps)
            at += 1
            if not len(numbers):
                continue
            hidden = share @ emb[numbers]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p * 0.1
            emb[numbers] -= (lr * 20) * share[:, None] * back
    return Model(langs, (emb @ out).astype(np.float32), bias)


def fit(rows: list[Row], names: list[str], seed: int = 11) -> Model | None:
    """Train, fit the temperature on a fifth held back, and set the rejection threshold from it; None without rows."""
    if not rows:
        return None
    langs = sorted(set(names))
    code = {x: i for i, x in enumerate(langs)}
    y = np.array([code[x] for x in names])
    held = np.arange(len(rows)) % 5 == 4
    inn = np.flatnonzero(~held)
    model = sgd([rows[i] for i in inn], y[inn], langs, seed=seed)
    seen = np.zeros(1 << BITS)
    for i in inn:
        seen[rows[i][0]] += rows[i][1]
    model.known = np.log((seen + 1) / (seen.sum() + len(seen))).astype(np.float32)
    total = max(1.0, seen.sum())
    centre = float(seen @ model.known / total)
    model.scatter = float(np.sqrt(seen @ (model.known.astype(np.float64) - centre) ** 2 / total))
    mean = lambda table, row: row[1] @ table[row[0]].astype(np.float64) / max(1, row[1].sum())
    if held.any():
        z = np.stack([mean(model.table, rows[i]) + model.bias for i in np.flatnonzero(held)])
        truth = y[held]
        best = (np.inf, 1.0)
        for heat in np.geomspace(0.05, 20, 60):
            s = z * heat
            s -= s.max(1, keepdims=True)
            loss = -(s[np.arange(len(truth)), truth] - np.log(np.exp(s).sum(1))).mean()
            best = min(best, (loss, float(heat)))
        model.heat = best[1]
        known = [mean(model.known, rows[i]) for i in np.flatnonzero(held) if len(rows[i][0])]
        if known:
            low, middle = np.quantile(known, [REJECT_QUANTILE, 0.5])
            model.reject = float(low - REJECT_SLACK * (middle - low))
    return model


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each whole text and their counts."""
    for batch in batches:
        raw, offsets, _ = buffers(batch.column(2))
        total, numbers, times = np.zeros(1 << BITS, np.int64), [], []
        for _, piece, last in text_blocks(raw, offsets, max(ORDERS) - 1):
            total += np.bincount(grams(piece), minlength=1 << BITS)
            if last:
                at = np.flatnonzero(total)
                numbers.append(at.astype(np.int32))
                times.append(total[at].astype(np.int32))
                total[at] = 0
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (numbers, times)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "lang", "grams", "times"])


def train(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> Model | None:
    """Fit on at most ``max_docs`` rows with text and lang, those whose ids and langs hash lowest (a bounded sample), and on all their n-grams.

    Of rows that repeat an id and a lang the text that hashes lowest counts.
    """
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null and doc_id is not null")
    chosen = rows.select("doc_id", "lang").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(max_docs)
    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = texts.mapInArrow(_counted, "doc_id long, lang string, grams array<int>, times array<int>").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    return fit([(a.values.to_numpy(), b.values.to_numpy()) for a, b in zip(got["grams"], got["times"], strict=True)], got["lang"].to_pylist())


def _predicted(shared, text_at: int, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw, offsets, nulls = buffers(batch.column(text_at))
            n = batch.num_rows
            pred, score, reject = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            total, known, count, letter = 0.0, 0.0, 0, False
            for i, piece, last in text_blocks(raw, offsets, max(ORDERS) - 1):
                if model is not None:
                    g = grams(piece)
                    total = total + model.table[g].sum(0, dtype=np.float64)
                    known += model.known[g].sum(dtype=np.float64)
                    count += len(g)
                    letter = letter or has_letter(piece)
                if last:
                    if letter and not nulls[i]:
                        p = model.probabilities(total, count)
                        k = int(p.argmax())
                        pred[i], score[i], reject[i] = model.langs[k], p[k], model.rejects(known / max(count, 1), count)
                    total, known, count, letter = 0.0, 0.0, 0, False
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred), pa.array(score), pa.array(reject)], names=[*batch.schema.names, *names])

    return run


RESULT = ("lang_pred", "score", "rejected")


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", names: tuple[str, ...] = RESULT) -> DataFrame:
    """All columns of ``docs`` and the language, its probability and whether it is rejected under ``names``, without a shuffle."""
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = StructType([*rows.schema.fields, *[StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType()), strict=True)]])
    return rows.mapInArrow(_predicted(spark.sparkContext.broadcast(model), rows.columns.index(text_col), names), schema)


def identify(docs: DataFrame, held_out=None, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for each row of ``docs``.

    ``held_out``: a Column over doc_id; those rows are not learned from.  A text that is null or has no letter
    gets ``und``, score 0 and is rejected; so does every text if no row can be learned from.  Very long texts are
    read in blocks, whole.
    """
    test = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~test), max_docs)
    out = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", test.alias("held_out"), *RESULT)


def keep_identified(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns; trained on their own languages.

    If no row can be learned from, nothing is rejected but texts without a letter cannot be told, so all rows stay.
    Columns may have any names: those of the prediction are drawn apart from them.
    """
    model = train(docs, max_docs)
    if model is None:
        return docs
    names = tuple(free_name(docs, "__" + x) for x in RESULT)
    return predict(docs, model, names=names).where(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])

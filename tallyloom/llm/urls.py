"""URL filters: allow and block rules, and a ratio of two character language models for the rest.

Each model is a variable-order Markov model of bytes with Witten-Bell smoothing: the estimate of order k mixes the
context's counts with the estimate of order k - 1, down to a uniform one.  Counts come from all URLs that a rule allows
(or blocks) and are kept for the contexts themselves, in a distributed table that grows with the contexts the URLs hold.
A symbol and the ORDER before it make a gram; its suffixes are the shorter contexts, so the gain of a gram is worked out once and
joined to the URLs that hold it.  A URL without a rule is allowed if the log-likelihood difference of the two models, per
byte, reaches a threshold; that is calibrated on one rule-labelled URL in five with models of the other four.

The rules' own text is what labels the training URLs; the models see the URL behind its scheme, lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored
from tallyloom.llm.textops import FOLD, buffers

ORDER = 4
ALLOW, BLOCK = "allow", "block"
CALIBRATION_BINS = 4001
LIMIT = 20.0
FIXED = float(1 << 40)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null fields if none does.  Of equally long ones the first by text wins."""
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        hit = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return none if out is None else out.otherwise(none)


def _symbols() -> np.ndarray:
    """Class of each byte: 0 is the end mark, 1..26 letters, 27..36 digits, punctuation each its own as far as 61 goes, 62 other ASCII, 63 beyond."""
    out = np.full(256, 62, dtype=np.int64)
    out[128:] = 63
    out[97:123] = np.arange(1, 27)
    out[48:58] = np.arange(27, 37)
    for i, c in enumerate(b"-._~:/?#[]@!$&'()*+,;=%|"):
        out[c] = 37 + i
    return out


_SYMBOL = _symbols()[FOLD.astype(np.int64)]
#: a cell is a context, 7 bits a symbol with the nearest lowest and 64 before the start, and 6 bits of the symbol that follows
CELLS = 1 << (7 * ORDER + 6)


def cells(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order 0..ORDER the cell (context, symbol) of every byte and end mark of all rows, and the row of each."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size + 1)
    at = np.arange(len(row)) - np.repeat(offsets[:-1] + np.arange(n), size + 1)
    symbol = np.zeros(len(row), dtype=np.int64)
    symbol[at < size[row]] = _SYMBOL[raw]
    context = np.zeros(len(row), dtype=np.int64)
    out = [symbol.copy()]
    for k in range(1, ORDER + 1):
        before = np.full(len(row), 64, dtype=np.int64)
        before[k:] = symbol[:-k] if k < len(row) else 64
        before[at < k] = 64
        context |= before << (7 * (k - 1))
        out.append((context << 6) | symbol)
    return out, row


class Markov:
    """The models of one machine, from counts of cells: what the distributed ones must equal."""

    def __init__(self, cell: np.ndarray, n: np.ndarray) -> None:
        self.counts = dict(zip(cell.tolist(), n.tolist(), strict=True))
        self.totals, self.kinds = {}, {}
        for c, m in self.counts.items():
            self.totals[c >> 6] = self.totals.get(c >> 6, 0) + m
            self.kinds[c >> 6] = self.kinds.get(c >> 6, 0) + 1

    def difference(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean over each row's bytes and end mark of ln p(allowed) - ln p(blocked)."""
        found, row = cells(raw, offsets)
        p = np.full((2, len(row)), 1 / 64)
        for k, cell in enumerate(found):
            for s in (0, 1):
                for i, c in enumerate((cell + (s * (ORDER + 1) + k) * CELLS).tolist()):
                    total, kinds = self.totals.get(c >> 6, 0), self.kinds.get(c >> 6, 0)
                    if total:
                        p[s, i] = (self.counts.get(c, 0) + kinds * p[s, i]) / (total + kinds)
        gain = np.log(p[1]) - np.log(p[0])
        return np.bincount(row, weights=gain, minlength=len(offsets) - 1) / (np.diff(offsets) + 1)


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, group, text) to one row per byte and end mark: (id, group, cell of order ORDER)."""
    for batch in batches:
        raw, offsets, _ = buffers(batch.column(2))
        found, row = cells(raw, offsets)
        for lo in range(0, len(row), 100_000):
            at = pa.array(row[lo : lo + 100_000])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(found[ORDER][lo : lo + 100_000])], names=["id", "group", "gram"])


#: groups of labelled URLs (2 * side + left out for calibration), and the models: each side over all, and over those not left out
_GROUPS = ["g0", "g1", "g2", "g3"]
_MODELS = {"all0": ["g0", "g1"], "all1": ["g2", "g3"], "fit0": ["g0"], "fit1": ["g2"]}


def gains(counts: DataFrame) -> DataFrame:
    """(gram, all, fit): ln p(allowed) - ln p(blocked) of each gram of ``counts`` (gram, g0..g3), in units of 1 / FIXED.

    ``all`` is of the models of all labelled URLs, ``fit`` of those not left out.  Whole units add up alike in any order.
    """
    base = counts.select("gram", *[sum(F.col(g) for g in groups).alias(m) for m, groups in _MODELS.items()])
    told = None
    for k in range(ORDER + 1):
        cell = base.groupBy(F.col("gram").bitwiseAND((1 << (7 * k + 6)) - 1).alias("cell")).agg(*[F.sum(m).alias(m) for m in _MODELS])
        whole = Window.partitionBy(F.shiftright("cell", 6))
        cell = cell.select("cell", *_MODELS, *[F.sum(m).over(whole).alias("t_" + m) for m in _MODELS], *[F.sum((F.col(m) > 0).cast("long")).over(whole).alias("k_" + m) for m in _MODELS])
        if told is None:
            known = cell.select("*", *[F.lit(1 / 64).alias("p_" + m) for m in _MODELS])
        else:
            shorter = F.col("cell").bitwiseAND((1 << (7 * (k - 1) + 6)) - 1)
            known = cell.withColumn("shorter", shorter).join(told.withColumnRenamed("cell", "shorter"), "shorter")
        mixed = lambda m: (F.col(m) + F.col("k_" + m) * F.col("p_" + m)) / (F.col("t_" + m) + F.col("k_" + m))
        told = known.select("cell", *[F.when(F.col("t_" + m) > 0, mixed(m)).otherwise(F.col("p_" + m)).alias("p_" + m) for m in _MODELS])
    gain = lambda x: F.round((F.log("p_" + x + "1") - F.log("p_" + x + "0")) * FIXED).cast("long").alias(x)
    return told.select(F.col("cell").alias("gram"), gain("all"), gain("fit"))


def calibrated(bins: list[tuple[int, int, int]]) -> float:
    """The threshold of least mean error over the two sides, from (side, bin, count); of equally good ones the nearest to 0."""
    table = np.zeros((2, CALIBRATION_BINS))
    for side, at, n in bins:
        table[side, at] += n
    total = table.sum(1)
    if not total.all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(table, 1)], 1)
    error = below[1] / total[1] + (total[0] - below[0]) / total[0]
    edges = (np.arange(CALIBRATION_BINS + 1) / (CALIBRATION_BINS - 1) * 2 - 1) * LIMIT
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(edges[best[np.abs(edges[best]).argmin()]])


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, score (length-normalised difference) and threshold of each row of ``pages``.

    A null url, or one without ``://``, has empty host and path and no rule; the models then see the url itself (null: an empty
    text).  If the rules label URLs of one side only, or none, a URL without a rule is allowed at score 0.  Repeated rows are
    judged one by one; a very long url counts in full.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rest = F.coalesce(F.regexp_replace("url", r"(?s)^.*?://", ""), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"), rest.alias("__rest"), F.xxhash64("url").alias("__hash"))
    rows = rows.withColumn("__hit", matched(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "__rest", "__hash", F.col("__hit.rule").alias("rule"), F.col("__hit.verdict").alias("ruled"))
    held = (F.pmod(F.col("__hash"), F.lit(5)) == 0).cast("int")
    group = F.when(F.col("ruled").isNotNull(), 2 * (F.col("ruled") == ALLOW).cast("int") + held)
    rows = stored(rows.withColumn("__group", group).drop("__hash").withColumn("__id", F.monotonically_increasing_id()), "urls")
    spelled = rows.select(F.col("__id").alias("id"), F.col("__group").alias("group"), "__rest").mapInArrow(_spelled, "id long, group int, gram long")
    counts = stored(spelled.groupBy("gram").agg(*[F.sum((F.coalesce("group", F.lit(-1)) == i).cast("long")).alias(g) for i, g in enumerate(_GROUPS)]), "grams")
    n = [x or 0 for x in counts.agg(*[F.sum(g) for g in _GROUPS]).first()]
    if not (n[0] + n[1] and n[2] + n[3]):
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(ALLOW)).alias("verdict"), F.lit(0.0).alias("score"), F.lit(0.0).alias("threshold"))
    score = spelled.join(gains(counts), "gram").groupBy(F.col("id").alias("__id")).agg(*[(F.sum(x) / FIXED / F.count("*")).alias("__" + x) for x in ("all", "fit")])
    scored = stored(rows.drop("__rest").join(score, "__id"), "scores")
    threshold = 0.0
    if n[0] and n[2]:
        at = F.floor((F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("__fit"))) / LIMIT + 1) / 2 * (CALIBRATION_BINS - 1)).cast("int")
        bins = scored.where("__group in (1, 3)").groupBy(F.floor(F.col("__group") / 2).alias("side"), at.alias("at")).count().collect()
        threshold = calibrated([(r["side"], r["at"], r["count"]) for r in bins])
    told = F.when(F.col("__all") >= threshold, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", told).alias("verdict"), F.col("__all").alias("score"), F.lit(threshold).alias("threshold"))

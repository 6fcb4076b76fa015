"""Reading vector columns into numpy, and marking the vectors that can be searched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, v: array<double>) of rows with an id and a vector that is neither null nor empty, and whose components are neither null nor non-finite.

    ``zero``: whether vectors of zeros stay.  Vectors of another length than the most common (of equally common ones the
    shortest) are left out.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (common["d"] if common else 0))


def matrix(column: pa.Array | pa.ChunkedArray, n: int, dtype=np.float64) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if n == 0:
        return np.zeros((0, 0), dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1)


def best(scores: np.ndarray, ids: np.ndarray, own: int | None, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, without ``own``."""
    at = np.arange(len(ids)) if own is None else np.flatnonzero(ids != own)
    if len(at) > k:
        part = scores[at]
        floor = np.partition(part, len(part) - k)[len(part) - k]
        at = at[part >= floor]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def looked_up(values, at) -> Column:
    """The long at place ``at`` of a list of bounded length, which folds to one literal."""
    return F.element_at(F.split(F.lit(",".join(str(int(x)) for x in values)), ","), at.cast("int") + 1).cast("long")


def packed(rows: DataFrame, keys: list[str], vector: str, dtype: type, more: list[str] = []) -> DataFrame:  # noqa: B006
    """One row for each value of ``keys`` (longs): the rows' vec_id, vector and ``more`` columns (8-byte numbers) as bytes.

    Groups have a bounded size: the caller salts them.
    """
    names = ["vec_id", vector, *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> pa.RecordBatch:
            blobs = [b"".join(x[i].tobytes() for x in held) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in now], *[pa.array([b], pa.binary()) for b in blobs]], names=[*keys, *names])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys))])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            values = [batch.column(len(keys)).to_numpy(zero_copy_only=False), matrix(batch.column(len(keys) + 1), batch.num_rows, dtype), *[batch.column(len(keys) + 2 + i).to_numpy(zero_copy_only=False) for i in range(len(more))]]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                mine = tuple(key[:, lo].tolist())
                if mine != now and held:
                    yield flush()
                    held = []
                now = mine
                held.append([x[lo:hi] for x in values])
        if held:
            yield flush()

    schema = ", ".join([*[f"{k} long" for k in keys], *[f"{c} binary" for c in names]])
    dealt = rows.select(*[F.col(k).cast("long").alias(k) for k in keys], *names).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def merged(held: list[np.ndarray], new: tuple[np.ndarray, ...], k: int) -> list[np.ndarray]:
    """The k best of each query among (query, vector, score) held and new: by query, then best first."""
    both = [np.concatenate(x) for x in zip(held, new, strict=True)]
    order = np.lexsort((both[1], -both[2], both[0]))
    both = [x[order] for x in both]
    keep = np.arange(len(order)) - np.searchsorted(both[0], both[0], "left") < k
    return [x[keep] for x in both]


def kth(held: list[np.ndarray], q_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th score that each query holds, or -inf."""
    lo, hi = np.searchsorted(held[0], q_ids, "left"), np.searchsorted(held[0], q_ids, "right")
    out = np.full(len(q_ids), -np.inf)
    full = hi - lo >= k
    out[full] = held[2][hi[full] - 1]
    return out


Fold = Callable[[tuple, tuple, list], tuple]


def meet(queries: DataFrame, blocks: DataFrame, k: int, scores: type, fold: Fold, result: str) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in the blocks sent to its place.

    ``queries`` (place, slice, bytes...) and ``blocks`` (place, slice, turn, bytes...) are packed.  A block of queries stays in its task with the best that it holds,
    while blocks of vectors pass by one at a time in order of ``turn``; ``fold(query block, block, held)`` gives what a block adds.  So a task holds two
    blocks, and gives k rows for each query.
    """
    keys = ["place", "slice"]
    ask, give = ([c for c in df.columns if c not in (*keys, "turn")] for df in (queries, blocks))
    width = max(len(ask), len(give))
    blob = lambda names, i: F.col(names[i]).cast("binary") if i < len(names) else F.lit(None).cast("binary")
    side = lambda df, kind, turn, names: df.select(*keys, F.lit(kind).alias("kind"), turn.alias("turn"), *[blob(names, i).alias(f"b{i}") for i in range(width)])
    both = side(queries, 0, F.lit(0).cast("long"), ask).unionByName(side(blocks, 1, F.col("turn").cast("long"), give))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, held = None, None, []
        out = lambda: pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1]), pa.array(held[2])], names=["query_id", "vec_id", "score"])
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if batch.column(2)[i].as_py() == 0:
                    if now is not None:
                        yield out()
                    now, block = key, tuple(batch.column(4 + j)[i].as_py() for j in range(len(ask)))
                    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, scores)]
                elif key == now:
                    held = merged(held, fold(block, tuple(batch.column(4 + j)[i].as_py() for j in range(len(give))), held), k)
        if now is not None:
            yield out()

    return both.repartition(*keys).sortWithinPartitions(*keys, "kind", "turn").mapInArrow(run, result)


def slices(query_blocks: int, wanted: int = 64) -> int:
    """Into how many parts the blocks that pass by a query block are dealt: more than one only where query blocks are too few to keep a cluster busy."""
    return max(1, -(-wanted // max(1, query_blocks)))

"""Exact top-k by inner product: norm-bucketed retrieval.

Vectors are grouped by length into buckets whose lengths differ by at most a sixteenth of an octave; those of more than
``bucket_rows`` are split by hash.  A query starts from a bound: its k-th score among the longest vectors.  In a bucket of greatest length L the
query q can only gain from vectors whose cosine with it is at least

    t = bound / (|q| L)                                   (the local threshold)

If t > 1 the whole bucket falls away.  If t is high, *coordinate* pruning bounds each product by the focus
coordinates' partial product plus the lengths of both rests; if it is low, *length* pruning scans the bucket in falling length and
stops where |q| |v| < bound.  Survivors' products are verified in integers, and raise the bound.

A block of queries stays in its task while the buckets that are long enough for the least demanding of its queries pass by, longest first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows, stored
from tallyloom.llm.vectors import best, kth, looked_up, matrix, meet, packed, slices, usable

BUCKET_ROWS = 2048
OCTAVE = 8
QUERY_ROWS = 512
SEED_ROWS = 1024
HIGH_COSINE = 0.6
FOCUS = 16
RESULT = "query_id long, vec_id long, score long"


def local_threshold(bound: float, query_length: float, longest: float) -> float:
    """The least cosine that a vector of the bucket needs; 0 or less prunes nothing."""
    return bound / (query_length * longest) if query_length > 0 and longest > 0 else (-1.0 if bound <= 0 else np.inf)


def search_bucket(q_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """Up to k (query, vector, score) per query with score >= its bound, and how many products each rule left.

    Vectors whose id is the query's own are left out.  Bounds are scores that k other vectors are known to reach (-inf if unknown).
    """
    length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    ids, v, length = ids[order], v[order], length[order]
    focus = min(FOCUS, v.shape[1])
    out: tuple[list, list, list] = ([], [], [])
    count = {"skipped": 0, "coordinate": 0, "length": 0}
    slack = 1e-6
    for i in range(len(q_ids)):
        x, bound = q[i], bounds[i]
        norm = float(np.sqrt(float((x.astype(np.float64) ** 2).sum())))
        t = local_threshold(bound, norm, float(length[0]))
        if t > 1 + slack:
            count["skipped"] += 1
            continue
        if np.isfinite(bound) and t >= HIGH_COSINE:
            axes = np.argsort(-np.abs(x), kind="stable")[:focus]
            part = v[:, axes].astype(np.float64) @ x[axes].astype(np.float64)
            seen = (v[:, axes].astype(np.float64) ** 2).sum(1)
            rest_v = np.sqrt(np.maximum(length**2 - seen, 0))
            rest_q = np.sqrt(max(norm**2 - float((x[axes].astype(np.float64) ** 2).sum()), 0.0))
            at = np.flatnonzero(part + rest_v * rest_q >= bound - slack * (1 + abs(bound)))
            count["coordinate"] += len(at)
        elif np.isfinite(bound) and bound > 0:
            at = np.arange(np.searchsorted(-length * norm, -(bound - slack * (1 + bound)), "right"))
            count["length"] += len(at)
        else:
            at = np.arange(len(ids))
            count["length"] += len(at)
        if not len(at):
            continue
        scores = v[at] @ x
        top = best(scores, ids[at], int(q_ids[i]), k)
        top = top[scores[top] >= bound]
        out[0].append(np.full(len(top), q_ids[i]))
        out[1].append(ids[at][top])
        out[2].append(scores[top])
    done = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return done[0], done[1], done[2], count


def norm_bucketed(table: DataFrame, is_query, k: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank, vec_id, score.

    Components become floor(scale * x).  ``is_query``: a Column over vec_id.  Candidates are all vectors but those of the query's
    own id; ties go to the smaller vec_id.  Vectors that are null, empty, or hold null or non-finite components take no part, nor do
    those of an uncommon length.  Vectors of zeros take part.  Rows that repeat an id with its vector count once.
    An empty table gives no rows.
    """
    spark = table.sparkSession
    arrow_rows(spark)
    rows = usable(table, id_col, vector_col, zero=True)
    whole = rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("w")).dropDuplicates(["vec_id", "w"])
    norm = F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x * x)
    # a sixteenth of an octave of length is an eighth of one of its square; zeros are group -1
    group = F.when(F.col("norm2") > 0, F.floor(F.log2(F.col("norm2").cast("double")) * OCTAVE)).otherwise(-1).cast("long")
    whole = stored(whole.withColumn("norm2", norm).withColumn("g", group), "vectors")
    # there are at most 63 * OCTAVE + 2 groups, whatever the number of rows
    parts = {r["g"]: -(-r["n"] // bucket_rows) for r in whole.groupBy("g").agg(F.count("*").alias("n")).collect()}
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = max(parts)
    split = lambda g: looked_up([parts.get(i, 0) for i in range(-1, top + 1)], g + 1)
    buckets = stored(packed(whole.withColumn("salt", F.pmod(F.xxhash64("vec_id"), split(F.col("g")))), ["g", "salt"], "w", np.int64), "buckets")
    longest = [(r["vec_id"], r["w"]) for r in whole.orderBy(F.desc("norm2"), "vec_id").limit(SEED_ROWS).collect()]
    seed_ids, seed = np.array([x[0] for x in longest], np.int64), np.array([x[1] for x in longest], np.int64)
    queries = whole.where(is_query).select("vec_id", "w")
    q_blocks = max(1, -(-queries.count() // query_rows))

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, w = batch.column(0).to_numpy(), matrix(batch.column(1), batch.num_rows, np.int64)
            bounds, reach = np.full(len(own), -np.inf), np.full(len(own), -np.inf)
            for i in range(len(own)):
                scores = np.sort(seed[seed_ids != own[i]] @ w[i])
                length = np.sqrt(float((w[i] * w[i]).sum()))
                if len(scores) >= k:
                    bounds[i] = scores[-k]
                    reach[i] = bounds[i] / length if length else (-np.inf if bounds[i] <= 0 else np.inf)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bounds), pa.array(reach)], names=["vec_id", "w", "bound", "reach"])

    asked = queries.mapInArrow(seeded, "vec_id long, w array<long>, bound double, reach double")
    asked = stored(asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks))), "asked")
    # the least group whose vectors can be long enough for the least demanding query of a block
    reach = asked.groupBy("qb").agg(F.min("reach").alias("reach"))
    least = reach.select("qb", F.when(F.col("reach") == float("inf"), top).when(F.col("reach") > 0, F.floor(2 * F.log2("reach") * OCTAVE - 1e-6)).otherwise(-1).cast("long").alias("least"))
    groups = least.select("qb", F.explode(F.sequence(F.least("least", F.lit(top)), F.lit(top).cast("long"))).alias("g")).withColumn("n", split(F.col("g"))).where("n > 0")
    cells = groups.select("qb", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"))
    dealt = slices(q_blocks)
    travelling = buckets.join(cells, ["g", "salt"]).select(F.col("qb").alias("place"), F.pmod(F.xxhash64("g", "salt"), F.lit(dealt)).alias("slice"), (-F.col("g")).alias("turn"), "vec_id", "w")
    staying = packed(asked.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(dealt - 1).cast("long")))).withColumnRenamed("qb", "place"), ["place", "slice"], "w", np.int64, ["bound"])

    def verified(block: tuple, bucket: tuple, held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, q_ids = np.frombuffer(bucket[0], np.int64), np.frombuffer(block[0], np.int64)
        bounds = np.maximum(np.frombuffer(block[2], float), kth(held, q_ids, k))
        return search_bucket(q_ids, np.frombuffer(block[1], np.int64).reshape(len(q_ids), -1), bounds, ids, np.frombuffer(bucket[1], np.int64).reshape(len(ids), -1), k)[:3]

    return ranked(meet(staying, travelling, k, np.int64, verified, RESULT), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's candidates: query_id, rank, vec_id, score; a pair that was found twice counts once."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    tops = pairs.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "score"))), 1, k).alias("top"))
    flat = tops.select("query_id", F.posexplode("top").alias("at", "hit"))
    return flat.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))

"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every row is then put into the leaf that it descends to.  A query walks the tree with a
priority queue of nodes: the greatest inner product with a node's centre, plus what the node's spread may add, comes first, and leaves are visited in
the order they come off the queue.  How many leaves are visited is calibrated: for a bounded set of queries the exact neighbours are found by
one pass over all rows, and the visits widen until the mean share of neighbours inside visited leaves reaches ``recall``.

A node comes off the queue no later than another if the least priority on its path is higher.  So a query needs to carry only one number, the
least priority that it has accepted: a leaf is visited if no node on its path is below.  Neighbouring leaves are packed into blocks of bounded size
(a leaf that holds a third of all rows is many blocks); a block of similar queries stays in its task while the blocks that any of them visits pass by.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows, stored
from tallyloom.llm.norm_buckets import ranked
from tallyloom.llm.vectors import best, kth, looked_up, matrix, meet, merged, packed, slices, usable

SAMPLE = 20_000
BRANCH = 12
LEAF_SAMPLE = 32
SPREAD = 2.0
CALIBRATION = 256
RECALL = 0.96
BLOCK_ROWS = 2048
BLOCK_QUERIES = 1024


class Tree:
    """Nodes in arrays: ``centre``, ``spread`` (root mean square of a component around it), ``first`` and ``count`` of children (0: a leaf), ``leaf``
    number (-1: inner).  Leaves are numbered so that those of a node are neighbours."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf_sample: int = LEAF_SAMPLE, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        self.centre, self.first, self.count, self.leaf = [sample.mean(0)], [0], [0], [-1]
        todo, self.leaves = [(0, np.arange(len(sample)), 0)], 0
        while todo:
            node, rows, depth = todo.pop()
            parts = [] if len(rows) <= leaf_sample or depth > 20 else self._split(sample[rows], min(branch, -(-len(rows) // leaf_sample) + 1), draw)
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            self.first[node], self.count[node] = len(self.centre), len(parts)
            for centre, mine in parts:
                todo.append((len(self.centre), rows[mine], depth + 1))
                self.centre.append(centre)
                self.first.append(0)
                self.count.append(0)
                self.leaf.append(-1)
        self.centre = np.array(self.centre)
        self.half = (self.centre**2).sum(1) / 2
        self.parent = np.full(len(self.centre), -1)
        for node, (lo, n) in enumerate(zip(self.first, self.count, strict=True)):
            self.parent[lo : lo + n] = node if n else self.parent[lo : lo + n]
        self.node_of_leaf = np.flatnonzero(np.array(self.leaf) >= 0)[np.argsort([x for x in self.leaf if x >= 0])]
        leaf = self.place(sample)
        square, rows = np.zeros(len(self.centre)), np.zeros(len(self.centre))
        at, mine = self.node_of_leaf[leaf], np.arange(len(sample))
        while len(mine):
            np.add.at(square, at, ((sample[mine] - self.centre[at]) ** 2).mean(1))
            np.add.at(rows, at, 1)
            mine, at = mine[self.parent[at] >= 0], self.parent[at][self.parent[at] >= 0]
        self.spread = np.sqrt(square / np.maximum(rows, 1))

    @staticmethod
    def _split(x: np.ndarray, k: int, draw: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        centres = x[draw.choice(len(x), size=min(k, len(x)), replace=False)]
        label = np.zeros(len(x), np.int64)
        for _ in range(12):
            new = (x @ centres.T - (centres**2).sum(1) / 2).argmax(1)
            if (new == label).all() and _:
                break
            label = new
            for j in range(len(centres)):
                if (label == j).any():
                    centres[j] = x[label == j].mean(0)
        return [(x[label == j].mean(0), np.flatnonzero(label == j)) for j in range(len(centres)) if (label == j).any()]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf each row descends to, by the nearest centre at every node."""
        node = np.zeros(len(x), np.int64)
        out = np.full(len(x), -1, np.int64)
        live = np.arange(len(x))
        first, count, leaf = np.array(self.first), np.array(self.count), np.array(self.leaf)
        while len(live):
            for n in np.unique(node[live]):
                mine = live[node[live] == n]
                if leaf[n] >= 0:
                    out[mine] = leaf[n]
                else:
                    c = slice(first[n], first[n] + count[n])
                    node[mine] = first[n] + (x[mine] @ self.centre[c].T - self.half[c]).argmax(1)
            live = live[out[live] < 0]
        return out

    def priority(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """(queries, nodes): what the walk orders nodes by."""
        return q @ self.centre[nodes].T + SPREAD * np.sqrt((q**2).sum(1))[:, None] * self.spread[nodes]

    def visits(self, q: np.ndarray, most: int) -> tuple[list[int], float]:
        """The first ``most`` leaves in best-bin-first order, and the least priority accepted on the way."""
        near = self.priority(q[None], np.arange(len(self.centre)))[0]
        queue, out, least = [(-near[0], 0)], [], np.inf
        while queue and len(out) < most:
            p, n = heapq.heappop(queue)
            least = min(least, -p)
            if self.leaf[n] >= 0:
                out.append(self.leaf[n])
            else:
                for c in range(self.first[n], self.first[n] + self.count[n]):
                    heapq.heappush(queue, (-near[c], c))
        return out, least

    def accepted(self, q: np.ndarray, least: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """(queries, leaves): whether no node on a leaf's path is below what a query accepts."""
        at = self.node_of_leaf[leaves]
        out = np.ones((len(q), len(leaves)), bool)
        while (at >= 0).any():
            nodes, place = np.unique(at, return_inverse=True)
            out &= (self.priority(q, nodes) >= least[:, None] - 1e-9)[:, place] | (at < 0)
            at = np.where(at >= 0, self.parent[at], -1)
        return out


def top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, seen: np.ndarray | None = None, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best (query, vector, score) among ``ids`` (where ``seen``, and of at least the score ``least``).  One product of matrices finds who can be among them; scores are each summed in one order."""
    near = q @ v.T
    if seen is not None:
        near[~seen] = -np.inf
    near[q_ids[:, None] == ids] = -np.inf
    floor = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k] if near.shape[1] > k else np.full(len(q), -np.inf)
    floor = floor if least is None else np.maximum(floor, least)
    floor -= 1e-9 * (1 + np.where(np.isfinite(floor), np.abs(floor), 0))
    a, b, c = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for i in np.flatnonzero((near >= floor[:, None]).any(axis=1)).tolist():
        at = np.flatnonzero((near[i] >= floor[i]) & (near[i] > -np.inf))
        scores = np.einsum("ij,j->i", v[at], q[i])
        keep = best(scores, ids[at], None, k)
        a.append(np.full(len(keep), q_ids[i]))
        b.append(ids[at][keep])
        c.append(scores[keep])
    return np.concatenate(a), np.concatenate(b), np.concatenate(c)


RESULT = "query_id long, vec_id long, score double"


def exact(rows: DataFrame, queries: list, k: int) -> DataFrame:
    """Each of a bounded list of (id, vector) queries against all rows (vec_id, v), each task keeping its k best."""
    q_ids, q = np.array([x[0] for x in queries], np.int64), np.array([x[1] for x in queries], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            if batch.num_rows:
                held = merged(held, top(q_ids, q, batch.column(0).to_numpy(), matrix(batch.column(1), batch.num_rows), k, None, kth(held, q_ids, k)), k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["query_id", "vec_id", "score"])

    return ranked(rows.select("vec_id", "v").mapInArrow(run, RESULT), k)


def search(table: DataFrame, is_query, k: int, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """Each query's k nearest found by inner product: query_id, rank, vec_id, score, visits, leaves.

    ``is_query``: a Column over vec_id.  Candidates are all rows but those of the query's own id; ties go to the smaller vec_id.
    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those of an uncommon length.
    Rows that repeat an id with its vector count once.  An empty table gives no rows.
    """
    spark = table.sparkSession
    arrow_rows(spark)
    rows = stored(usable(table, id_col, vector_col, zero=False).dropDuplicates(["vec_id", "v"]), "vectors")
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()["v"]
    if not len(drawn):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visits int, leaves int")
    tree = Tree(matrix(drawn, len(drawn)))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.place(matrix(batch.column(1), batch.num_rows)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=["vec_id", "v", "leaf"])

    placed = stored(rows.mapInArrow(place, "vec_id long, v array<double>, leaf long"), "placed")
    queries = placed.where(is_query)
    few = [(r["vec_id"], r["v"]) for r in queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION).collect()]
    if not few:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visits int, leaves int")
    truth = exact(rows, few, k)
    true_leaves = truth.join(placed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    visits = calibrated_visits(tree, few, [(r["query_id"], r["leaf"]) for r in true_leaves], recall)
    # leaves in blocks, queries in blocks of neighbours: a number for each leaf, and how many blocks it is split into
    row_block, row_parts = _blocks(placed, tree.leaves, BLOCK_ROWS)
    query_block, query_parts = _blocks(queries, tree.leaves, BLOCK_QUERIES)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [shared.value.visits(x, visits)[1] for x in matrix(batch.column(1), batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.float64())], names=["vec_id", "v", "leaf", "least"])

    dealt = lambda df, block, parts: df.withColumn("block", block).withColumn("part", F.pmod(F.xxhash64("vec_id"), parts))
    index = packed(dealt(placed, row_block, row_parts), ["block", "part"], "v", float, ["leaf"])
    asked = queries.mapInArrow(walk, "vec_id long, v array<double>, leaf long, least double")
    asked = stored(packed(dealt(asked, query_block, query_parts), ["block", "part"], "v", float, ["least"]).withColumn("place", F.monotonically_increasing_id()), "asked")
    n_slices = slices(asked.count())
    members = {r["block"]: (r["leaves"], r["parts"]) for r in placed.groupBy(row_block.alias("block"), row_parts.alias("parts")).agg(F.collect_set("leaf").alias("leaves")).collect()}

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(place, block, part) of each part of each block of leaves that any query of a block visits."""
        for batch in batches:
            for i in range(batch.num_rows):
                least = np.frombuffer(batch.column(2)[i].as_py(), float)
                q = np.frombuffer(batch.column(1)[i].as_py(), float).reshape(len(least), -1)
                met = [(block, part) for block, (leaves, parts) in members.items() if shared.value.accepted(q, least, np.array(leaves)).any() for part in range(parts)]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(met), pa.int64()), *[pa.array([x[j] for x in met], pa.int64()) for j in (0, 1)]], names=["place", "block", "part"])

    def score(asking: tuple, rows: tuple, held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, leaf, q_ids = np.frombuffer(rows[0], np.int64), np.frombuffer(rows[2], np.int64), np.frombuffer(asking[0], np.int64)
        v, q = np.frombuffer(rows[1], float).reshape(len(ids), -1), np.frombuffer(asking[1], float).reshape(len(q_ids), -1)
        here, place = np.unique(leaf, return_inverse=True)
        return top(q_ids, q, ids, v, k, shared.value.accepted(q, np.frombuffer(asking[2], float), here)[:, place], kth(held, q_ids, k))

    cells = asked.select("place", "v", "least").mapInArrow(visited, "place long, block long, part long")
    slice_of = F.pmod(F.xxhash64("block", "part"), F.lit(n_slices))
    travelling = index.join(cells, ["block", "part"]).select("place", slice_of.alias("slice"), F.lit(0).alias("turn"), "vec_id", "v", "leaf")
    staying = asked.select("place", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long"))).alias("slice"), "vec_id", "v", "least")
    found = ranked(meet(staying, travelling, k, float, score, RESULT), k)
    return found.withColumn("visits", F.lit(visits)).withColumn("leaves", F.lit(tree.leaves))


def _blocks(df: DataFrame, leaves: int, rows: int):
    """Columns over ``leaf``: the number of the block that a leaf belongs to, and how many parts that block is split into.

    Neighbouring leaves share a block of about ``rows``; larger leaves are split.  Only the leaves' sizes come to the driver, as many as the tree has leaves.
    """
    size = np.zeros(leaves, np.int64)
    for r in df.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        size[r["leaf"]] = r["n"]
    block, parts, filled = np.zeros(leaves, np.int64), [1], 0
    for leaf in range(leaves):
        if filled and filled + size[leaf] > rows:
            parts.append(1)
            filled = 0
        block[leaf] = len(parts) - 1
        filled += int(size[leaf])
        parts[-1] = max(1, -(-filled // rows))
    return looked_up(block, F.col("leaf")), looked_up(np.array(parts)[block], F.col("leaf"))


def calibrated_visits(tree: Tree, queries: list, true_leaves: list[tuple[int, int]], recall: float) -> int:
    """Fewest leaves to visit so that on average ``recall`` of each query's true neighbours lie in them."""
    by: dict[int, list[int]] = {}
    for q, leaf in true_leaves:
        by.setdefault(q, []).append(leaf)
    curve, n = np.zeros(tree.leaves), 0
    for q, v in queries:
        if q in by:
            at = {leaf: i for i, leaf in enumerate(tree.visits(np.asarray(v, float), tree.leaves)[0])}
            curve += np.bincount([at[x] for x in by[q]], minlength=tree.leaves) / len(by[q])
            n += 1
    if not n:
        return tree.leaves
    reached = np.cumsum(curve) / n
    return int(min(tree.leaves, np.searchsorted(reached, recall - 1e-12) + 1))

"""Connected components of a graph held in DataFrames: union-find by contraction.

Each round hooks every node to its least neighbour, follows the hooks to their ends by doubling, relabels, and contracts
the edges.  An end that no node hooks to has a neighbour that hooks to a lesser end, to which it hooks itself in the next
round; so two rounds at least halve the nodes left, and the doublings of a round are as many as the bits of its longest
chain.  Every round is written to the shared folder; nothing but whether edges are left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def _ends(hook: DataFrame) -> DataFrame:
    """``hook`` (node, to) with every ``to`` replaced by the end of its chain; ends hook to themselves."""
    while True:
        on = hook.where("node != to").select(F.col("node").alias("to"), F.col("to").alias("next"))
        if hook.join(on, "to", "left_semi").isEmpty():
            return hook
        hook = stored(hook.join(on, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "hooks")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the least node reachable.

    Self-loops only add their node.  No edges: no rows.
    """
    both = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    live = stored(both.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    loops = both.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    while not live.isEmpty():
        ends = live.select(F.col("a").alias("node"), F.col("a").alias("to")).unionByName(live.select(F.col("b").alias("node"), F.col("a").alias("to")))
        hook = _ends(stored(ends.groupBy("node").agg(F.min("to").alias("to")), "hooks"))
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            old = labels.join(hook.select(F.col("node").alias("component"), "to"), "component", "left")
            labels = stored(old.select("node", F.coalesce("to", "component").alias("component")), "labels")
        moved = live.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(hook.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        live = stored(moved.where("ta != tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if labels is None:
        return loops.distinct()
    return labels.unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))

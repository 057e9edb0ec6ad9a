"""Connected components of an edge table, by hooking, pointer jumping and contraction.

Every step is a join or an aggregation over edges; each result is written to the shared folder,
so that lineage stays short and a lost executor costs one step, and is deleted when the next no
longer needs it. Nothing is collected but whether a step changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.shared import Scratch


def _jumped(up: DataFrame) -> DataFrame:
    """(node, up, moved): each node's parent's parent. Every parent is a node of the table."""
    above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
    return up.select("node", "up").join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): ``root`` is the smallest node reachable. Loops and repeats are harmless."""
    current = scratch.stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    total = None
    while total is None or not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hook = scratch.stored(_jumped(_jumped(hook)), "hook")  # as deep as the trees of stars are
        while not hook.filter("moved").isEmpty():
            before, hook = hook, scratch.stored(_jumped(hook), "hook")
            scratch.drop(before)
        ends = lambda a, x: hook.select(F.col("node").alias(a), F.col("up").alias(x))  # noqa: B023, E731
        left = current.join(ends("a", "x"), "a").join(ends("b", "y"), "b").filter("x <> y")
        after = scratch.stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if total is None:  # all nodes are in the first edges
            total = scratch.stored(ends("node", "root"), "roots")
        else:
            before, total = total, scratch.stored(total.join(ends("root", "x"), "root", "left").select("node", F.coalesce("x", "root").alias("root")), "roots")
            scratch.drop(before)
        scratch.drop(current, hook)
        current = after
    scratch.drop(current)
    return total

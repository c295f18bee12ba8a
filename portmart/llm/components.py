"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm.staging import staged


def components(edges: DataFrame) -> DataFrame | None:
    """``(node, component)`` for every node of ``edges(a, b)``: the least node reachable; None if
    there is no edge.

    Each round points every node at its least neighbour (a minimum per node, summed up before the
    shuffle, so a node with very many neighbours stays one row per task), follows the pointers
    twice, and contracts the edges; at least half of the nodes go. Rounds are written tables."""
    rest = staged(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        hook = staged(hook, "hook")
        for _ in range(2):
            far = hook.select(F.col("node").alias("to"), F.col("to").alias("_next"))
            hook = hook.join(far, "to").select("node", F.col("_next").alias("to"))
        hook = staged(hook, "hook")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = staged(labels, "labels")
        for end in ("a", "b"):
            rest = rest.join(hook.select(F.col("node").alias(end), F.col("to").alias("_" + end)), end).drop(end).withColumnRenamed("_" + end, end)
        rest = staged(rest.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels

"""Connected components of an edge table by minimum hooking and pointer jumping.

Every round each node points at its smallest neighbour (or itself), pointers are
followed twice, and the edges are rewritten between the nodes pointed at.  A node that
is not its neighbours' minimum disappears each round, so the rounds grow with the
logarithm of the longest path.  Every step is a join or an aggregation with map-side
combining; each round's tables are written to the shared scratch folder, which cuts
the lineage.  Rewritten edges are made distinct, so hub nodes shrink at once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node reachable.  Nodes without edges are
    absent; null ends and loops are ignored; repeated edges count once."""
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    edges = materialize(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
                                     (a.isNull() | b.isNull()).alias("_n"))
                        .where("not _n and a < b").select("a", "b").distinct(), "cc-edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = materialize(both.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.min("b"), F.first("a")).alias("up")), "cc-hook")
        for _ in range(2):
            over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = hook.join(over, "up").select("node", F.col("top").alias("up"))
        hook = materialize(hook, "cc-jump")
        if labels is None:
            labels = hook.select("node", F.col("up").alias("root"))
        else:
            step = hook.select(F.col("node").alias("root"), "up")
            labels = labels.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        labels = materialize(labels, "cc-labels")
        to = lambda end: hook.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up"))
        edges = materialize(
            edges.join(to("a"), "a").join(to("b"), "b")
            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
            .where("a < b").distinct(), "cc-edges")
    return labels

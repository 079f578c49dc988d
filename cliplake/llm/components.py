"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Scratch


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Each round hands every node the smallest label around it (a partial minimum per task, so a node
    with very many edges costs no more than others) and then follows labels one step.  Rounds grow
    with the logarithm of the longest chain.  Each round's labels are written to the
    shared folder, as tables of the caller's ``scratch``.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = scratch.staged(
        both.union(both.select("other", "node")).where("node <> other").distinct(), "edges"
    )
    nearest = both.groupBy("node").agg(F.min("other").alias("near"))
    labels = scratch.staged(nearest.select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("label").alias("met"))
        near = (
            both.join(of_other, "other")
            .groupBy("node")
            .agg(F.min("met").alias("met"))
            .join(labels, "node")
            .select("node", F.least("met", "label").alias("step"), F.col("label").alias("was"))
        )
        jump = labels.select(F.col("node").alias("step"), F.col("label").alias("jump"))
        label = F.least("step", "jump")
        moved = near.join(jump, "step").select(
            "node", label.alias("label"), (label < F.col("was")).alias("moved")
        )
        moved = scratch.staged(moved, "labels")
        labels = moved.select("node", "label")
        if not moved.where("moved").limit(1).count():
            return labels.select("node", F.col("label").alias("component"))

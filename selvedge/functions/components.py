"""Connected components of an edge list, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvedge.functions.skew import join_unique
from selvedge.session import checkpointed


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node) for every node of an edge.

    Each round hands every node the smallest label among its neighbours and then follows that
    label one step (so distances halve), until nothing changes: labels only ever fall, so that
    comes. Rounds are cut with checkpoints.
    Nodes with very many edges are salted in the joins and reduced before the shuffle.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).where("node IS NOT NULL AND other IS NOT NULL").distinct()
    both = checkpointed(both)
    labels = checkpointed(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")))
    while True:
        near = join_unique(both, labels.select(F.col("node").alias("other"), "component"), ["other"]).groupBy("node").agg(F.min("component").alias("_near"))
        lower = labels.join(near, "node").select("node", F.least("component", "_near").alias("component"), F.col("component").alias("_was"))
        jumped = lower.select("node", "_was", F.col("component").alias("_at")).join(lower.select(F.col("node").alias("_at"), F.col("component").alias("_root")), "_at", "left")
        new = checkpointed(jumped.select("node", F.least("_at", F.coalesce("_root", "_at")).alias("component"), "_was"))
        labels = new.drop("_was")
        if not new.where("component != _was").limit(1).count():
            return labels

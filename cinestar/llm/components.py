"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.session import ensure_checkpoint_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node reachable, for edges (a, b) of comparable ids.

    Each round takes the smallest label among the neighbours and then that
    label's own label, so the number of rounds grows with the logarithm of the
    longest path rather than with its length. Labels are checkpointed round by
    round. Neighbours' labels are combined within tasks before the shuffle.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct().checkpoint()
    labels = (
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("component"))
        .checkpoint()
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hopped = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("via")
        )
        # Labels before the hop lead further down, so the shortcut may use them.
        further = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        after = (
            hopped.join(further, "via", "left")
            .select("node", "before", F.least("via", "further").alias("component"))
            .checkpoint()
        )
        changed = after.where("component <> before").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels

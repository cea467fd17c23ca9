"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import write_table


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node that it reaches) for every
    node of ``links`` (``a``, ``b``, both long).

    Each round takes the smallest label among the neighbours and then the
    label of that label, until nothing changes; every round is written. A
    node's neighbours are combined before they are shuffled, and the joins
    are by node, whose skew Spark splits, so a node may have any number of
    links."""
    edges = write_table(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = write_table(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")).select("node", "component"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node", "left").select("node", "component", F.least("component", "near").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("jump"))
        new = write_table(
            lower.join(jump, "lower", "left").select("node", F.least("lower", "jump").alias("component"), F.col("component").alias("old")), "labels"
        )
        changed = new.where("component < old").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels

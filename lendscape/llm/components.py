"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    Minimum labels travel along edges and labels are then shortened to the label of the label,
    so rounds grow with the logarithm of long chains. Each round is written to shared storage;
    one number per round comes to the driver. Minima are combined before they are shuffled.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    both = A.staged(both.filter("node != other").distinct(), "edges")
    labels = A.staged(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "labels"
    )
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("_heard"))
        )
        heard = labels.join(heard, "node").select(
            "node", "component", F.least("component", "_heard").alias("_new")
        )
        # A label is a node, too, and may have learned of a smaller one.
        of_label = heard.select(F.col("node").alias("_new"), F.col("_new").alias("_newer"))
        after = A.staged(
            heard.join(of_label, "_new").select(
                "node", F.least("_new", "_newer").alias("_next"), "component"
            ),
            "labels",
        )
        labels = after.select("node", F.col("_next").alias("component"))
        if after.filter(F.col("_next") != F.col("component")).isEmpty():
            return labels

"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable), for the nodes of edges (a, b).

    Each round takes the smallest label among a node's neighbours, then the label of that label,
    and writes the labels. A hub's rows are aggregated before the shuffle and never gathered.
    """
    both = written(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(),
        "edges",
    )
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("component")), "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("component").alias("seen"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        pulled = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("jumped"))
        moved = written(
            pulled.join(jump, "label", "left").select(
                "node", "before", F.least("label", F.coalesce("jumped", "label")).alias("component")),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component < before").isEmpty():
            return labels

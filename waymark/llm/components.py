"""Connected components of an edge table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.storage import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Each round a node takes the smallest label around it and then the label of that label,
    so a path of length n needs about log n rounds.  Labels live in a table in the shared
    folder; only the number of changed rows comes to the driver.  A node with very many
    edges is summed by partial aggregation.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")),
        "labels",
    )
    for _ in range(max_rounds):
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        own = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        labels = materialize(
            own.join(jump, "next").select(
                "node",
                F.least("next", "far").alias("component"),
                (F.least("next", "far") < F.col("old")).alias("changed"),
            ),
            "labels",
        )
        if not labels.where("changed").limit(1).count():
            break
        labels = labels.drop("changed")
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    return labels.select("node", "component")

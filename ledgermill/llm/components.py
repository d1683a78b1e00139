"""Connected components of links, as DataFrame joins: no component is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import checkpointed


def components(links: DataFrame) -> DataFrame:
    """node, component of every node of ``links`` (a, b): the smallest node that can be reached.

    Each round takes the least label among the neighbours, then the label of that label, which halves what
    is left of a chain. Minima are combined before the shuffle, so a node of any number of links is cheap.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = checkpointed(both)
    labels = checkpointed(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        moved = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("to")
        )
        far = labels.select(F.col("node").alias("to"), F.col("component").alias("beyond"))
        after = checkpointed(
            moved.join(far, "to", "left").select("node", "old", F.least("to", "beyond").alias("component"))
        )
        labels = after.select("node", "component")
        if not after.filter("component <> old").limit(1).count():
            return labels

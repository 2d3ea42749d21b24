"""Connected components by minimum labels with pointer jumping; links and labels stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of a link: the least node of its component.

    A null end, a loop and a repeated link add nothing; no links give no rows. Each round takes the least label of a
    node's neighbours and then the label of that label, and is written to the shared folder.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v"))
    edges = cut_lineage(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", "label", F.least("label", "near").alias("to"))
        up = labels.select(F.col("node").alias("to"), F.col("label").alias("above"))
        new = cut_lineage(
            step.join(up, "to").select("node", F.least("to", "above").alias("label"), (F.least("to", "above") != F.col("label")).alias("moved")),
            "labels",
        )
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels

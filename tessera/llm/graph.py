"""Connected components of a link table, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node is linked with.

    Every round takes the smallest label among a node's neighbours and then
    that label's own label (pointer jumping), until nothing changes.  Each
    round is written, so lineage and recovery stay short.  No links: no rows.
    """
    one = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    edges = land(one.unionByName(one.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(),
                 "links")
    labels = land(edges.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("component")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        closer = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = closer.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = land(closer.join(jump, "component", "left")
                    .select("node", "before", F.least("component", "far").alias("component")), "labels")
        labels = step.select("node", "component")
        if step.filter("component <> before").isEmpty():
            return labels

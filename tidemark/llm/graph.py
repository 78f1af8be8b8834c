"""Connected components by label propagation with pointer jumping, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .base import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a long, b long): label is the smallest node
    reachable. Null ends and self links are ignored, repeated links do no harm.

    A round takes the smallest label among a node's neighbours, then the label of that label, so
    chains halve and stars settle at once; both are joins of evenly splittable rows with partial
    aggregation, written to the shared folder between rounds.
    """
    one = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = staged(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("far"))
        new = staged(lower.join(jump, lower["label"] == jump["to"], "left")
                     .select("node", "old", F.least("label", "far").alias("label")), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")

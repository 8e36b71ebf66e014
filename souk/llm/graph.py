"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import materialise


def components(edges: DataFrame, free: bool = False) -> DataFrame:
    """``node, label``: the smallest node that each node of ``edges`` (a, b)
    reaches. Labels go over the edges and then jump to their label's label,
    so the rounds grow with the logarithm of a component's width; each
    round's table is written, and a hub's edges are combined before the
    shuffle and may be split by adaptive execution. With ``free`` each
    round's shuffle files go when its table is written."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links", free=free)
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("label")), "labels", free=free)
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = materialise(step.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels", free=free)
        labels = step.select("node", "label")
        if step.where("label < old").isEmpty():
            return labels

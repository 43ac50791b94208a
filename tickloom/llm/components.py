"""Connected components of a table of links, by minimum labels with pointer
jumping. Every step is a join and a partial aggregate on narrow rows; nothing
but the number of changed labels reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``links`` has long columns ``a, b``; returns ``node, label`` with the
    smallest node of the component as its label, for nodes that have a link."""
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        # the smallest label among the neighbours
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        # then the label of that label
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("up"))
        step = staged(step.join(up, step["label"] == up["at"], "left")
                      .select("node", "was", F.least("label", "up").alias("label")), "labels")
        labels = step.select("node", "label")
        if not step.where("label <> was").limit(1).count():
            return labels

"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.llm.arrow import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each end of the links (a, b); the component is its smallest node.

    A round gives each node the smallest label among itself and its neighbours, then the label of
    that label. Labels are written after every round, so a lost executor costs one round at most.
    Null ends are no nodes; a link of a node to itself makes it a component of its own.
    """
    both = links.where("a is not null and b is not null")
    both = written(both.select("a", "b").union(both.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "labels")
    labels = labels.select("node", F.least("node", "component").alias("component"))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        lower = written(lower, "labels")
        of = lower.select(F.col("node").alias("label"), F.col("component").alias("jump"))
        jumped = lower.join(of, lower.component == of.label).select(
            "node", "old", F.least("component", "jump").alias("component")
        )
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels

"""Connected components of a table of links, by spreading the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadastra.sources.staging import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest id reachable from every id that has a link.

    Each round takes the smallest label among the neighbours and then the label of that label, so chains
    shrink by half and more; every round is written down. Links may repeat and run either way.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stage(both.unionAll(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("component")), "labels")
    while True:
        seen = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        nearer = labels.join(seen, labels["node"] == seen["u"]).select("node", "component", F.least("component", "near").alias("low"))
        of_label = labels.select(F.col("node").alias("__label"), F.col("component").alias("lowest"))
        jumped = nearer.join(of_label, nearer["low"] == of_label["__label"])
        rounds = stage(jumped.select("node", "component", F.least("low", "lowest").alias("next")), "labels")
        labels = rounds.select("node", F.col("next").alias("component"))
        if rounds.where("next <> component").isEmpty():
            return labels

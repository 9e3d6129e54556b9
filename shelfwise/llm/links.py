"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.storage import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable from it.

    Every round gives a node the smallest label around it and then the label of that label, so long
    chains shrink by half or more. Links and labels stay in tables; only the number of changes is
    read by the driver. A hub's links meet in partial minima before they are shuffled.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("beyond"))
        jumped = lower.join(roots, lower["new"] == roots["root"], "left")
        stepped = cut(jumped.select("node", "old", F.least("new", "beyond").alias("component")))
        changed = stepped.where("component <> old").limit(1).count()
        labels = stepped.drop("old")
        if not changed:
            return labels

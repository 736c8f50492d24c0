"""Connected components of a table of links, by shrinking labels and jumping along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.store import dropped, written


def components(links: DataFrame) -> DataFrame:
    """links (a, b), in any order and number, to (node, label): label is the smallest node of the component.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so
    long chains halve. Tables of the shared folder carry the labels from round to round.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = written(both, "links")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        new = lower.join(far, "label", "left")
        new = written(new.select("node", F.least("label", "jump").alias("label"), "was"), "labels")
        changed = new.filter("label <> was").limit(1).count()
        dropped(labels)
        labels = new.select("node", "label")
        if not changed:
            return labels

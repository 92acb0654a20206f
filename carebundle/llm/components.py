"""Connected components of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Each round a node takes the smallest label among its own and its neighbours', and then that label's own label, so long
    chains shorten by half.  Labels are written each round; only sums come to the driver.  A node with very many links
    is a hot join key with one row on the other side, which adaptive execution splits, and its minimum is a partial
    aggregate.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "component-edges")
    labels = stored(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        named = labels.withColumnsRenamed({"node": "b", "label": "other"})
        near = edges.join(named, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        taken = labels.join(near, "node").select("node", "label", F.least("label", "other").alias("taken"))
        jump = labels.withColumnsRenamed({"node": "taken", "label": "root"})
        moved = taken.join(jump, "taken", "left").select(
            "node", F.least("taken", F.coalesce("root", "taken")).alias("label"), F.col("label").alias("old")
        )
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")

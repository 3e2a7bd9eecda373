"""Connected components of a table of links, without a hot key and without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.sizes import broadcast_if_small
from larder.session import settle


def linked_components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of the links ``a, b``: the smallest node that it reaches.

    Each round takes the smallest label of a node's neighbours, summed up in the tasks first, and
    then follows the labels once: a label is looked up among the distinct labels, not by each node
    of a large component. Rounds go on until no label changes; only that count is seen here. Links
    may repeat. No links give no rows.
    """
    ends = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = settle(ends.distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = settle(labels.select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b")
        lowered = settle(
            around.select(F.col("a").alias("node"), "label")
            .unionByName(labels)
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.max("label").alias("highest")),
            "lowered",
        )
        jumps = (
            lowered.select("label")
            .distinct()
            .join(lowered.select(F.col("node").alias("label"), F.col("label").alias("further")), "label")
        )
        labels = settle(
            lowered.join(broadcast_if_small(settle(jumps, "jumps")), "label").select(
                "node", F.col("further").alias("label")
            ),
            "labels",
        )
        # A node whose neighbours and itself had one label, everywhere: nothing is left to spread.
        if not lowered.where("label <> highest").limit(1).count():
            return labels

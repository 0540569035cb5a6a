"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.llm import hot
from pathwake.llm.hot import hot_keys, sent, spread_join
from pathwake.runtime import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is the component's least node.

    Each round takes the least label among a node's neighbours and then the label of that label,
    so the rounds grow with the logarithm of a component's width. Labels are written to the
    shared folder after each round; only the number of changed labels reaches the driver. Nodes
    with very many links, and labels of very many nodes, are dealt to several tasks. An empty
    table of links has no nodes. Loops and repeated links change nothing.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a is not null and b is not null").distinct(),
        "links",
    )
    n = both.count()
    small = n <= hot.SMALL_ROWS
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels", n)
    hubs = None if small else hot_keys(both.groupBy("b").agg(F.count("*").alias("n")), ["b"])
    while True:
        near = (
            spread_join(both, sent(labels.withColumnRenamed("node", "b"), n), ["b"], hubs, F.col("a"))
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        hooked = near.join(sent(labels, n), "node").select("node", "label", F.least("label", "near").alias("low"))
        large = None
        if not small:
            hooked = stored(hooked, "hooked", n)
            large = hot_keys(hooked.groupBy("low").agg(F.count("*").alias("n")), ["low"])
        above = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        moved = stored(
            spread_join(hooked, sent(above, n), ["low"], large, F.col("node")).select("node", F.least("low", "next").alias("label"), (F.col("low") < F.col("label")).alias("moved")),
            "labels", n,
        )
        labels = moved.select("node", "label")
        if not moved.filter("moved").limit(1).count():
            return labels

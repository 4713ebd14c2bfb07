"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``; the label is the component's least node.

    Every round, a node and its present label take the least label among the node's neighbours, and
    every label is replaced by its own label. Labels only fall; the rounds end when their
    sum stays, after a number of rounds that grows with the logarithm of the longest chain. All
    groupings are minima that combine before the shuffle, and joins carry no wider grouping above
    them, so a component may hold any share of the nodes.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    )
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now is None or now == total:
            return labels
        total = now
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("least"))
        )
        seen = labels.join(near, "node").select("node", "label", "least")
        offers = seen.select(
            F.explode(
                F.array(
                    F.struct("node", F.least("label", "least").alias("label")),
                    F.struct(F.col("label").alias("node"), F.least("label", "least").alias("label")),
                )
            ).alias("o")
        ).select("o.*")
        hooked = stored(offers.groupBy("node").agg(F.min("label").alias("label")))
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = stored(hooked.join(above, "label").select("node", F.col("up").alias("label")))

"""Connected components of a table of links, by least label with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``links (a, b)``: the least node it can reach.

    Every round takes the least label among neighbours, then the label of the label, so a
    chain of n links needs about log n rounds. Rounds are written tables. Nothing is
    collected; a node's neighbours meet as partial minima.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        )
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("lower")
        )
        ends = labels.select(F.col("node").alias("lower"), F.col("label").alias("end"))
        moved = written(
            lower.join(ends, "lower", "left").select(
                "node", "label", F.least("lower", F.coalesce("end", "lower")).alias("moved")
            )
        )
        done = moved.where("moved < label").isEmpty()
        labels = moved.select("node", F.col("moved").alias("label"))
        if done:
            return labels

"""Connected components of links, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for the ends of links (a, b). Each round takes the least label among neighbours, then the label of that label; rounds are written tables."""
    edges = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = written(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid")), "low")  # so that a label of many nodes can be split among tasks
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("jump"))
        after = written(low.join(jump, "mid").select("node", "old", F.least("mid", "jump").alias("label")), "labels")
        if after.where("old <> label").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")

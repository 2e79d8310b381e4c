"""Connected components of links between documents, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractlake.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links(a, b): root is the smallest node that it reaches.

    Every node takes the smallest label among its neighbours, then the label of its label, so that long chains shorten
    geometrically; it ends when no label changes.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("heard"))
        told = labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("near"))
        told = cut(told)
        jump = told.select(F.col("node").alias("near"), F.col("near").alias("far"))
        new = cut(told.join(jump, "near", "left").select("node", "old", F.least("near", F.coalesce("far", "near")).alias("root")))
        changed = new.where("old <> root").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels

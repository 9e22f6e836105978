"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import Scratch, materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of a link; ``component`` is the smallest node that can be reached.

    Every round is a few equi-joins on tables of one row for each node or link, written to the shared
    folder; a hub's links are pre-aggregated before they are shuffled by node.
    """
    with Scratch(links.sparkSession) as scratch:
        links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
        both = scratch.table(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
        label = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("l"))
        label = scratch.table(label, "labels")
        while True:
            near = both.join(label.select(F.col("node").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
            low = label.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("l").alias("was"), F.least("l", "m").alias("l"))
            low = scratch.table(low, "low")
            up = low.select(F.col("node").alias("l"), F.col("l").alias("l2"))
            nxt = scratch.table(low.join(up, "l").select("node", "was", F.least("l", "l2").alias("l")), "labels")
            label = nxt.select("node", "l")
            if nxt.where("l <> was").isEmpty():
                return materialize(label.withColumnRenamed("l", "component"), "components")

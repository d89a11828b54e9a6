"""Connected components of a link table: components hook on to their smallest neighbour until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signwatch.llm.tables import spread_join, tidy, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reached) for every node of the links ``a, b``; no links, no rows.

    In a step each component finds the smallest component that one of its nodes has a link to, hooks on to it if that is
    smaller, and then points where that one points. Of the components that are not done at least half disappear in a step.
    Tables are written between steps. Nodes with many links and components with many nodes are broadcast to them.
    """
    links = links.filter("a <> b")
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("next")).union(links.select("b", "a")).distinct(), "links")
    n = both.count()
    labels = both.groupBy("node").agg(F.least("node", F.min("next")).alias("component"), F.count("next").alias("links"))
    labels = written(labels, "labels")
    while True:
        near = labels.select(F.col("node").alias("next"), F.col("component").alias("near"), "links")
        near = spread_join(both, near, "next", "links", n).groupBy("node").agg(F.min("near").alias("near"))
        parents = labels.join(near, "node").groupBy("component").agg(F.min("near").alias("near"), F.count("node").alias("nodes"))
        parents = written(parents.select("component", F.least("component", "near").alias("parent"), "nodes"), "parents")
        ahead = parents.select(F.col("component").alias("parent"), F.col("parent").alias("ahead"))
        ahead = parents.groupBy("parent").agg(F.count("component").alias("followers")).join(ahead, "parent", "left")
        ahead = ahead.withColumn("ahead", F.coalesce("ahead", "parent"))
        jumped = spread_join(parents, ahead, "parent", "followers", n).select("component", "ahead", "nodes")
        if parents.filter("parent <> component").isEmpty():
            return labels.select("node", "component")
        labels = spread_join(labels, jumped, "component", "nodes", n)
        labels = written(labels.select("node", F.col("ahead").alias("component"), "links"), "labels")
        tidy(links.sparkSession)

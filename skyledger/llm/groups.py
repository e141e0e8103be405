"""Connected components of a link table, as label tables that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources.staging import stage


def smallest_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) for every node.

    Alternates the two steps of star contraction: each node's larger neighbours, then its
    smaller ones, are linked to the least neighbour instead. The number of links never
    grows and the rounds are about the logarithm of the longest path. A hub's neighbours
    are only minimised over and rejoined by key, so its rows stay rows. Each round is
    staged, so a lost executor costs one round.
    """
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links-0"
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "links-least")
        # larger neighbours b > a go to the least of a's neighbourhood
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "links-large")
        # smaller neighbours and the node itself go to the least smaller neighbour
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = stage(small.filter("a <> b").distinct(), "links-small")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stage(
        nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "links-labels"
    )

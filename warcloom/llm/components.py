"""Connected components of links as tables: star contraction, no graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links(a, b); the component is its smallest node.

    Rounds of two star steps until nothing changes: each node hangs its larger neighbours below its smallest neighbour,
    then its smaller neighbours below the smallest of them. A node's neighbours are never gathered: the smallest is an
    aggregate, which is joined back, so a node with a third of all links is no task of its own.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.distinct())
        # done when every node hangs below one root and no root hangs below another
        below = edges.groupBy("a").agg(F.count("*").alias("n"))
        roots = edges.select(F.col("b").alias("a")).distinct()
        if below.where("n > 1").select("a").union(below.select("a").join(roots, "a", "left_semi")).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())

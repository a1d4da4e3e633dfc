"""Connected components of a link table, without gathering any node's links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally import session


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every linked node.

    Large-star and small-star steps alternate: each node's larger neighbours, then its
    smaller ones, are hung onto its smallest neighbour, until every node is hung onto one
    that hangs onto none. Smallest neighbours are aggregates, so a node with very many
    links is no burden; each round is stored, and the number of rounds grows as a logarithm.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = session.materialize(edges, "links")
    while True:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
        both = edges.union(edges.select("v", "u"))
        # stored, so that the join is between plain shuffles and a node with very many larger neighbours can be split
        least = session.materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: links point from larger to smaller nodes here
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m").alias("v")))
        edges = session.materialize(small.where("u != v").distinct(), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

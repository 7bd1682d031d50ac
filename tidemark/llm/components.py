"""Connected components of a table of links, by alternating large and small stars over written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) reaches.

    Each round joins nodes only with the smallest neighbour of their own, which
    is combined before the shuffle; nothing is gathered, and the rounds grow
    with the logarithm of the longest path.  Ends when a round changes no link.
    """
    edges = written(links.where("a != b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "links")
    before = None
    while True:
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = edges.union(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v")
        # small star: u and its smaller neighbours go to the smallest of them
        large = large.where("u != v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v != m").selectExpr("v as u", "m as v").union(lower.selectExpr("u", "m as v"))
        edges = written(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

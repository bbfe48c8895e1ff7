"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.sources.shared import shared_dir


def components(links: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between nodes to ``(node, component)``, the smallest node that is reachable.

    Nodes without links do not come out. Each round hangs the neighbours of
    every node under the smallest one, the larger first, then the smaller. It
    ends when no node with a smaller neighbour has any other, so that each
    component is a star around its smallest node, after a number of rounds that
    grows with the logarithm of the longest path; links that are such stars
    already need none. Links are kept in the shared folder after each round.
    """
    shared_dir(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct().checkpoint()
    while True:
        both = edges.select(F.inline(F.array(_edge("u", "v"), _edge("v", "u"))))
        near = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if near.filter("m < u and n > 1").isEmpty():
            stars = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
            return edges.select(F.inline(stars)).distinct()
        large = both.join(near.select("u", F.least("m", "u").alias("m")), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every u now has smaller neighbours only
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = small.select(F.inline(F.array(_edge("v", "m"), _edge("u", "m")))).filter("u <> v").distinct().checkpoint()


def _edge(u: str, v: str) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(v).alias("v"))

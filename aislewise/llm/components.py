"""Connected components by alternating large-star and small-star, for the near-duplicate operators.

Nodes are numbers. A star step never gathers a
node's neighbours: the smallest neighbour is a map-side minimum, and the edges are joined with it. A hub with a third
of all nodes is therefore no group in one task; adaptive execution splits it in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.session import cut_lineage


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b) with b < a, each pair once.

    Large: every node links its larger neighbours to the smallest of its neighbourhood and itself. Small: it links its
    smaller neighbours, and itself, to the smallest of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        found = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("low"))
        others = edges.join(least, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        found = others.unionByName(least.select("a", F.col("low").alias("b")))
    return found.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); a component's name is its smallest node.

    Each round is checkpointed in the shared folder. The steps end when nothing changes any more: then every node but
    the smallest of a component links to that one alone.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == now or not now[0]:
            break
        state = now
        edges = cut_lineage(star(star(edges, large=True), large=False))
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, and what it hangs on hangs on nothing.

    One pass: per node, how often it hangs, and whether something hangs on it.
    """
    roles = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
                                           F.struct(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))).alias("x"))
    per = roles.select("x.*").groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return per.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to one row (node, component) per linked node; the component is its smallest node.

    Alternates two star rounds until stars are left: every neighbour larger
    than a node, then every smaller one, is hung on the smallest neighbour.  Edges
    never grow in number, the rounds grow with the logarithm of the longest chain,
    and a node's neighbours are never gathered (its minimum is an aggregate).
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # larger neighbours of a node to its least neighbour
        edges = (edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b"))
        # smaller neighbours of a node, and itself, to the least of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(hung.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

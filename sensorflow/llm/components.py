"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def connected(links: DataFrame, label: str = "components") -> DataFrame:
    """`node` and `root` (the smallest node reachable) for every node of `links` (columns `a`, `b`).

    Alternates two star steps until nothing changes: every node's larger neighbours are tied to its
    smallest one, then all its smaller neighbours. Rounds grow with the logarithm of the longest
    path, links never become more than they were but for one per node, and each round is a stored
    table. Nodes are compared by Spark's order; links of a node with itself and repeated links
    change nothing; a link with a null end is left out.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        label,
    )
    before = None
    while (mark := _mark(edges)) != before:
        before = mark
        edges = stored(_smaller(stored(_larger(edges), label)), label)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    others = edges.join(smallest, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return others.union(smallest.select("hi", F.col("m").alias("lo"))).distinct()

"""Connected components of a table of links, by rounds of joins; nothing of it goes to the driver but one count a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from detlake.session import durable


def _print(edges: DataFrame) -> tuple:
    """Tells whether two tables of distinct links are the same."""
    return tuple(edges.where("a <> b").agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of `links` (a, b: long).

    Each round links every node's larger neighbours, and then its smaller ones, to the smallest node known to it, until
    nothing changes; the number of rounds grows with the logarithm of the longest chain. Grouping keeps one minimum per node, so a node with many
    links costs no more than its rows. Null links are left out; links of a node to itself and repeated links are harmless."""
    edges = durable(links.where("a IS NOT NULL AND b IS NOT NULL")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    seen = _print(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # every larger neighbour of a node moves to the smallest one the node knows
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # the smallest ones stay nodes; smaller neighbours of a node move to its smallest
        large = durable(large.unionByName(edges.where("a = b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges, before = durable(moved), seen
        seen = _print(edges)
        if seen == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))

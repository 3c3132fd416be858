"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import select_into


def components(links: DataFrame) -> DataFrame:
    """For each node of ``links`` (``a``, ``b``, both not null) the smallest node it reaches.

    Returns ``node`` and ``root``, one row for each node linked to another. Two
    steps take turns. The first hangs every larger neighbour of a node on the
    node's smallest neighbour, the second does so with the smaller ones; the
    links then are stars around the roots after a few rounds, about the
    logarithm of the longest path. Every round is written to the shared folder.
    Only the number of links and one checksum come to the driver.
    """
    edges = select_into(_larger_first(links))
    nodes, seen = edges, None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == seen:
            break
        seen = now
        edges = select_into(_small_star(_large_star(edges)))
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    ends = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return ends.join(stars, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _larger_first(links: DataFrame) -> DataFrame:
    """Distinct links as (larger, smaller), without links of a node to itself."""
    return (
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    ways = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    ways = ways.select("e.a", "e.b")
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    hung = ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _larger_first(hung)


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _larger_first(hung.union(least.select("a", F.col("low").alias("b"))))

"""Connected components by alternating star contractions, on keyed tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in ``edges`` (a, b).

    Each round hangs the neighbours of a node on the smallest of them, first the
    larger ones, then the smaller ones, until only stars are left; the number of
    rounds grows with the logarithm of a component's size, and edges that are
    stars take none. A round reads a table written by the one before. Smallest neighbours are found by a combined
    aggregate, so no node's neighbours are gathered anywhere.
    """
    pair = lambda u, v: [F.greatest(u, v).alias("a"), F.least(u, v).alias("b")]
    now = materialize(edges.where("a != b").select(*pair("a", "b")).distinct(), "edges")
    while not _only_stars(now):
        # large star: a node's larger neighbours hang on the smallest around it
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # rows that are found twice, never more than there were, go with those of the small star
        large = materialize(large.where("a != b"), "edges")
        # small star: a node and its smaller neighbours hang on the smallest of those
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        now = materialize(small.where("a != b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node ``a`` of distinct edges has one ``b``, which is no edge's ``a``: every ``b`` is a root then."""
    nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    nodes = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return not nodes.where("up > 1 or up > least").agg(F.count("*")).first()[0]

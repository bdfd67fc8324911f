"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .limits import written


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id of ``links`` (``a``, ``b``, any integers, any order).

    ``component`` is the smallest id that links reach. Every round points all neighbours of
    a node to the smallest of them, first the larger and then the smaller neighbours, so long
    chains shrink at a logarithmic rate. A node of any degree is only aggregated (combined in
    the tasks first) and joined, never gathered, and each round is written to the shared folder.
    """
    up, down = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a <> b").select(up.alias("a"), down.alias("b")).distinct()
    edges = written(edges, "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
            .join(least.select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        # Every u itself also moves to the smallest of its neighbours.
        large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = written(small, "small-star")
        # Done when every node has one parent and no parent has one: a forest of stars.
        if edges.groupBy("a").count().where("count > 1").isEmpty() and not _chained(edges):
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def _chained(edges: DataFrame) -> bool:
    """Whether some parent has a parent itself."""
    return not edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()

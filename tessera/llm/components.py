"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node around it."""
    all_edges = _both(edges)
    least = cut(all_edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return all_edges.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = cut(down.groupBy("a").agg(F.min("b").alias("m")))
    linked = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b: long) with the smallest node it reaches.

    Edges with a null end and loops are left out, so a node with no other edge has no row; repeated
    edges count once; no edges give an empty result.

    Alternates large-star and small-star steps until the edges are stars, which takes a number
    of rounds that grows with the logarithm of the nodes. Minima are summed in each task before
    the shuffle; minima are written to the shared folder before they are joined back, so that a
    node with very many edges is split over tasks.
    """
    edges = cut(edges.select("a", "b").filter("a != b").distinct())
    state = None
    while True:
        edges = cut(_small_star(_large_star(edges)))
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

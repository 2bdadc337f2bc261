"""Connected components by large and small stars, with every round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramline.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours at the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points its smaller neighbours, and itself, at the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a``, ``b``: the smallest node it reaches.

    Rounds repeat until none changes a link, so chains of any length come together; their number
    grows with the logarithm of the longest. A round groups with map-side minima and joins on
    the node, which adaptive skew handling splits where one node has very many links; nothing
    but a count and a checksum comes to the driver. Loops are dropped; no links give no rows.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select("b", "b").distinct()) if state[0] else nodes

"""Connected components of an edge table: alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import staged

MAX_ROUNDS = 40


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u is linked to the least node near u."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of u, and u, is linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns a, b: bigint).

    The component is its smallest node.  Every round is a few narrow joins; a
    node with very many neighbours is reduced by a partial minimum first, and
    the joins read one row per node on their other side, so AQE can split them.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    links = staged(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        links = staged(_small_star(_large_star(links)).distinct(), "edges")
        # Stable when every node points at its root and no root points on.
        now = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

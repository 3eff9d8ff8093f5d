"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.session import staged


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    inner = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, v`` rows of numeric ids to ``node, component`` rows, the component being its smallest id.

    Nodes that have no link to another node are not listed. Each round is written to the
    shared folder, so a lost executor costs no more than one round. The neighbourhood of a
    node is never gathered: a hub's links are aggregated in part before the shuffle, and its
    join partition can be split.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = staged(ordered, "links")
    seen = _digest(edges)
    if not seen[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        edges = staged(_small_star(_large_star(edges)), "links")
        now = _digest(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
    raise RuntimeError(f"components are not stable after {rounds} rounds")

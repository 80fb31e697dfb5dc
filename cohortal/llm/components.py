"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortal.sources.tables import stage


def _lowest(links: DataFrame) -> DataFrame:
    """Smallest neighbour of each node ``u``, the node itself included.

    It is a written table so that a join with it shuffles both sides and adaptive
    execution can split the links of a node with very many neighbours.
    """
    lowest = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return stage(lowest.withColumnRenamed("u", "at"), "lowest")


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = _both_ways(links)
    joined = both.where("v > u").join(_lowest(both), F.col("u") == F.col("at"))
    return joined.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = _lowest(down)
    joined = down.join(lowest, F.col("u") == F.col("at")).select(F.col("v").alias("u"), "low")
    hung = joined.union(lowest.select("at", "low")).where("u <> low")
    return hung.select("u", F.col("low").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one node, which hangs on none. Then a node hangs on the
    smallest of its component, as a small star hangs nodes on smaller ones only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(
        edges.select("v", F.lit(0))
    )
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every linked node.

    ``links`` has two columns of one integer type; order, repeats and loops don't matter,
    and rows with a null are ignored. Stars of larger and of smaller neighbours alternate
    until only stars are left, each step written to the shared folder.
    """
    a, b = links.columns
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    while True:
        edges = stage(_small_star(stage(_large_star(edges), "large")), "small")
        if _are_stars(edges):
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

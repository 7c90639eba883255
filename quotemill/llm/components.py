"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.joins import spread_join
from quotemill.llm.storage import stored

#: Parts that the links of a node with most of them are dealt to.
SALTS = 8


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of ``u`` is linked to the smallest of ``u`` and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return spread_join(both.where("v > u"), least, "u", SALTS).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``u`` and its smaller neighbours are linked to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = spread_join(edges, least, "u", SALTS).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the component being its smallest node.

    Each round is two grouped minima and joins on the node; no neighbour list is ever gathered, so a node
    with very many links costs rows, not memory. The number of rounds grows with the logarithm of the nodes.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

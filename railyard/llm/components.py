"""Connected components of an edge table by alternating large-star and small-star steps.

Edges live in tables of the shared folder between steps; nothing is collected. A node with very many edges is summed
before its shuffle (min). That minimum is stored before the edges meet it: a join of two tables is one whose hot
partition Spark splits, which it can't do where an aggregate on the same key feeds the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
    moved = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = stored(moved.distinct(), "large-star")
    discard(low)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    low = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    discard(low)
    return out


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (columns u, v): comp is the smallest node reachable."""
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    state = _state(edges)
    while state[0]:
        large = _large_star(edges)
        new_edges = _small_star(large)
        discard(edges, large)
        edges = new_edges
        new = _state(edges)
        if new == state:
            break
        state = new
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(stars.select(F.col("comp").alias("node"), "comp").distinct())

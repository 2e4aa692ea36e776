"""Connected components of a distributed graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import stored


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_min_neighbour(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _min_neighbour(low)
    moved = low.join(found, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(found.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its smallest node.

    Every step writes its edges, at most as many as it got. A node's edges are never gathered: each
    is joined to the node's smallest neighbour. No edges give no rows; loops and repeats are ignored.
    """
    now = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    before = _state(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

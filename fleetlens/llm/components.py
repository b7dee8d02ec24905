"""Connected components by alternating large-star and small-star, with no group held in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_folder, few, stored


def _least(edges: DataFrame, path: str, n: int) -> DataFrame:
    """Per node its least neighbour, itself included; stored, so that the join on it can split hot nodes."""
    return stored(few(edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), n), path)


def _large_star(edges: DataFrame, path: str, n: int) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, f"{path}-least", n)
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, path: str, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, f"{path}-least", n)
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); the component is its least node.

    Each half step is a pre-aggregated minimum per node and a join on it, stored in ``folder``;
    the steps end when the edges are stars: each node has one edge, and its centre has none of its own.
    Links from a node to itself and repeated links change nothing; no links give no rows.
    """
    edges = stored(links.filter("u <> v").select("u", "v").distinct(), f"{folder}/edges")
    n, step = edges.count(), 0
    while True:
        step += 1
        at = f"{folder}/step{step}"
        large = stored(few(_large_star(edges, f"{at}-large", n), n), f"{at}-large")
        edges = stored(few(_small_star(large, f"{at}-small", n), n), f"{at}-small")
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
            edges.select("v", F.lit(0), F.lit(1))
        )
        held = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        n, moving = held.agg(F.sum("down"), F.max(F.col("down") + F.col("up"))).first()
        if n is None or moving == 1:
            break
        for part in ("large", "large-least", "small-least"):
            drop_folder(edges.sparkSession, f"{at}-{part}")
    centers = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(centers)

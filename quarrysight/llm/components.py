"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _lowest(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest of u and its partners. A node with many
    partners is pre-aggregated; its rows may be split in the join."""
    low = pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return pairs.join(low, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _lowest(down)
    return (near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of long ids to (node, component): the smallest id reachable, for
    every node but the smallest of each component. Stored after each round."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .where("u != v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now).distinct()).where("u != v").distinct(), "edges")
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))

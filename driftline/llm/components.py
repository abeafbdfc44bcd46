"""Connected components of an edge list, by alternating star contraction.

Every round points the larger neighbours of each node at its smallest one, then
does the same with the smaller neighbours, until each node hangs directly on the
smallest node of its component. Rounds grow with the logarithm of the longest
chain. No task holds a component: a hub's rows can be split over tasks because
both sides of each join are dealt out for that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large-star"
    )
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` with a > b."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    moved = edges.join(least, "a").where("b <> m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def component_roots(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of
    ``edges`` (``a``, ``b``, of one orderable type, a <> b) that isn't a root."""
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        current = stored(_small_star(stored(_large_star(current), "stars")), "edges")
        if _state(current) == state:
            break
        state = _state(current)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))

"""Connected components by alternating large-star and small-star rounds of joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame, tmp: Scratch) -> DataFrame:
    """Each larger neighbour of u is tied to the smallest node among u and its neighbours."""
    near = _both_ways(edges)
    # Smallest neighbours are summed up before the shuffle and written apart, so that the join below may split a hub's neighbours over tasks.
    least = tmp.write(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"least-{uuid.uuid4().hex}")
    return near.where("v > u").join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))


def _small_star(edges: DataFrame, tmp: Scratch) -> DataFrame:
    """Each smaller neighbour of u, and u itself, is tied to the smallest of them."""
    near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = tmp.write(near.groupBy("u").agg(F.min("v").alias("m")), f"least-{uuid.uuid4().hex}")
    return near.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).unionAll(least.select(F.col("u").alias("b"), F.col("m").alias("a")))


def connected_components(edges: DataFrame, tmp: Scratch, name: str, rounds: int = 60) -> DataFrame:
    """(node, label) for each node of edges (a, b); label is the smallest node reachable.

    Ends when a round leaves the edges as they were, which is after a number of rounds
    that grows with the logarithm of the component size. Loops and repeated edges are
    allowed; no edges give no rows. Raises if the edges still change after ``rounds``.
    """

    def state(df: DataFrame):
        return tuple(df.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = tmp.write(edges.where("a <> b").select("a", "b").distinct(), f"{name}-0")
    seen = state(now)
    for k in range(1, rounds + 1):
        if not seen[0]:
            break
        part = Scratch(tmp.spark, name)
        large = part.write(_large_star(now, part).where("a <> b").distinct(), "large")
        after = tmp.write(_small_star(large, part).where("a <> b").select("a", "b").distinct(), f"{name}-{k}")
        part.drop("")
        tmp.drop(f"{name}-{k - 1}")
        now, before, seen = after, seen, state(after)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    labels = now.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return labels.unionAll(labels.select(F.col("label").alias("node"), "label").distinct())

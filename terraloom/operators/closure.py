"""Transitive closure of the dependency edges, whole and incremental.

Both are semi-naive: each round joins only the pairs found in the round before with the
edges, and drops what is known by an anti join. Rounds are written to the shared folder, so
plans stay small and nothing is computed twice; cycles end because pairs are a set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import WorkTables
from ..sources.store import Pairs


def _empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


#: So many rounds are held apart; then they are made one table, so that an anti join reads few.
APART = 4


def _grown(tmp: WorkTables, base: DataFrame, more: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """base and all that more(frontier) adds to it, round by round, until a round adds nothing."""
    known, frontier, k = [base], base, 0
    while not _empty(frontier):
        found = more(frontier)
        for one in known:
            found = found.join(one, keys, "left_anti")
        k += 1
        frontier = tmp.keep(found, f"round-{k}")
        known.append(frontier)
        if len(known) > APART:
            known = [tmp.keep(reduce(DataFrame.unionByName, known), f"known-{k}")]
    return reduce(DataFrame.unionByName, known)


def transitive_closure(edges: DataFrame) -> DataFrame:
    """(a, b): every b that contains a directly or indirectly, a itself left out."""
    tmp = WorkTables(edges.sparkSession, "closure")
    base = tmp.keep(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    # Only a container that is a member of something leads on.
    step = tmp.keep(base.select(F.col("a").alias("via"), F.col("b").alias("next")).join(base.select(F.col("b").alias("via")).distinct(), "via", "left_semi"), "steps")
    return _grown(tmp, base, lambda f: f.join(step, F.col("b") == F.col("via")).select("a", F.col("next").alias("b")).distinct(), ["a", "b"]).where("a <> b")


def new_index_edges(index: DataFrame | Pairs, edges: DataFrame) -> DataFrame:
    """What edges add to a transitively closed index, so that it is closed again.

    Every new path alternates closed old stretches and new edges, so only the index pairs
    that end at a new edge's member or start at its container take part; they are looked up.
    """
    index = index if isinstance(index, Pairs) else Pairs(index)
    tmp = WorkTables(edges.sparkSession, "increment")
    fresh = tmp.keep(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "new")
    down = index.about("b", fresh.select(F.col("a").alias("v")).distinct())
    up = index.about("a", fresh.select(F.col("b").alias("v")).distinct())
    closed = tmp.keep(transitive_closure(fresh.unionByName(down).unionByName(up)), "closed")
    return closed.join(index.about("a", closed.select(F.col("a").alias("v")).distinct()), ["a", "b"], "left_anti")


def reachable(seeds: DataFrame, steps: DataFrame) -> DataFrame:
    """(v, …): the seeds (v) and all that steps (src, dst) lead to from them; cycles are fine.

    Other columns of the seeds are handed on, so that several searches take the rounds of one.
    """
    tmp, other = WorkTables(seeds.sparkSession, "reach"), [c for c in seeds.columns if c != "v"]
    base = tmp.keep(seeds.where("v IS NOT NULL").distinct(), "round-0")
    steps = tmp.keep(steps.select("src", "dst").distinct(), "steps")
    return _grown(tmp, base, lambda f: f.join(steps, F.col("v") == F.col("src")).select(F.col("dst").alias("v"), *other).distinct(), ["v", *other])

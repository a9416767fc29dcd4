"""What a batch of changes affects, and every row needed to draw it before and after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import pack, partition_number, unpack_id, unpack_type
from ..schema import MEMORY, RANK, STORAGE, UPDATE
from ..sources.store import Pairs
from .edges import edges


def _pairs(index: DataFrame | Pairs) -> Pairs:
    return index if isinstance(index, Pairs) else Pairs(index)


def affected_containers(index: DataFrame | Pairs, keys: DataFrame) -> DataFrame:
    """(b): containers of the keys (v). As the index is closed, one look-up by member reaches all levels."""
    return _pairs(index).about("a", keys).select("b").distinct()


def affected_edges(index: DataFrame | Pairs, keys: DataFrame) -> DataFrame:
    """(a, b): all index pairs into the affected containers."""
    return _pairs(index).about("b", affected_containers(index, keys).select(F.col("b").alias("v")))


def changed_keys(update: DataFrame, repaired: bool = True) -> DataFrame:
    """(v): the packed keys whose surroundings change.

    Repaired: every changed entity. Otherwise only what the rows' own edges point at and
    the nodes themselves, so that a way that lost all vertices is not found.
    """
    if repaired:
        return update.select(pack(F.col("id"), F.col("type")).alias("v")).distinct()
    nodes = update.where("type = 'node'").select(pack(F.col("id"), F.col("type")).alias("v"))
    return nodes.unionByName(edges(update).select(F.col("b").alias("v"))).distinct()


def wanted(index: DataFrame | Pairs, update: DataFrame, repaired: bool = True) -> DataFrame:
    """(p, id, type) of the changed entities, what contains them, and all that is needed to draw those."""
    keys = changed_keys(update, repaired)
    containers = keys.unionByName(affected_containers(index, keys).select(F.col("b").alias("v"))).distinct()
    parts = _pairs(index).about("b", containers).select(F.col("a").alias("v"))
    every = containers.unionByName(parts).distinct()
    pair = every.select(unpack_id(F.col("v")).alias("id"), unpack_type(F.col("v")).alias("type"))
    return pair.select(partition_number(F.col("id"), F.col("type")).alias("p"), "id", "type")


def latest_origin(rows: DataFrame) -> DataFrame:
    """One row for each (type, id, version, timestamp): that of the best origin. Maps can't be compared, so keys are."""
    best = Window.partitionBy("type", "id", "version", "timestamp").orderBy("origin_rank")
    return rows.withColumn("__k", F.row_number().over(best)).where("__k = 1").drop("__k")


def with_origin(df: DataFrame, origin: str) -> DataFrame:
    return df.withColumn("origin", F.lit(origin)).withColumn("origin_rank", F.lit(RANK[origin]))


def augment(update: DataFrame, memory: DataFrame | None, storage: DataFrame, want: DataFrame) -> DataFrame:
    """The working set: changed rows, and the wanted rows not flushed yet and stored, without repeats."""
    pair = want.select("id", "type").distinct()
    rows = with_origin(update, UPDATE)
    if memory is not None:
        rows = rows.unionByName(with_origin(memory.join(pair, ["id", "type"], "left_semi").select(*update.columns), MEMORY))
    rows = rows.unionByName(with_origin(storage.join(pair, ["id", "type"], "left_semi").select(*update.columns), STORAGE))
    return latest_origin(rows)

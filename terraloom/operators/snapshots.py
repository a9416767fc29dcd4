"""Changes between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _content(prefix: str) -> Column:
    """Comparable form of a row: maps are compared as sorted entries."""
    c = lambda n: F.col(f"{prefix}.{n}")
    return F.struct(F.array_sort(F.map_entries(c("tags"))), c("lat"), c("lon"), c("nds"), c("members"), c("version"), c("visible"))


def snapshot_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(action, type, id, row): create, modify or delete for each entity that differs; a deletion has its old row."""
    o = old.select("type", "id", F.struct(*old.columns).alias("o"))
    n = new.select("type", "id", F.struct(*old.columns).alias("n"))
    both = o.join(n, ["type", "id"], "full")
    here, there = F.col("n").isNotNull() & F.coalesce(F.col("n.visible"), F.lit(True)), F.col("o").isNotNull() & F.coalesce(F.col("o.visible"), F.lit(True))
    action = F.when(here & ~there, "create").when(there & ~here, "delete").when(here & there & ~_content("o").eqNullSafe(_content("n")), "modify")
    return both.withColumn("action", action.cast("string")).where("action IS NOT NULL").select("action", "type", "id", F.coalesce("n", "o").alias("row"))

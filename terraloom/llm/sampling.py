"""Bounded, reproducible samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A sample of ids is broadcast up to this many rows; beyond it the join is left to Spark.
BROADCAST_ROWS = 200_000


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo mod; null for a null id."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % mod


def per_class(labelled: DataFrame, id_col: str, label_col: str, bound: int) -> DataFrame:
    """(id, label): of each label the bound rows whose id hashes lowest; null ids and labels are left out.

    An id that is listed more than once counts once, with its greatest label. Rows are ranked
    only within a label's cells of the hash (256 cells of 256 cells each), after the cells'
    counts have told which of them the sample needs, so no task ranks all rows of a label.
    """
    one = labelled.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    place = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 48)  # the sixteen highest bits, in the order of h
    rows = one.withColumn("h", F.xxhash64("id")).withColumns({"c1": F.shiftright(place, 8), "c2": place.bitwiseAND(F.lit(255).cast("long"))}).withColumn("left", F.lit(bound).cast("long"))
    for cells in (["label", "c1"], ["label", "c1", "c2"]):
        n = rows.groupBy(*cells).agg(F.count("*").alias("n"), F.first("left").alias("left"))
        before = F.sum("n").over(Window.partitionBy(*cells[:-1]).orderBy(cells[-1])) - F.col("n")
        needed = n.withColumn("left", F.col("left") - before).where("left > 0").select(*cells, "left")
        rows = rows.drop("left").join(needed, cells)
    rank = F.row_number().over(Window.partitionBy("label", "c1", "c2").orderBy("h", "id"))
    return rows.withColumn("rank", rank).where("rank <= left").select("id", "label")


def with_text(sample: DataFrame, docs: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, text) of the sampled documents; rows is the number of rows in sample."""
    if rows <= BROADCAST_ROWS:
        sample = F.broadcast(sample)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id")

"""Shared-folder scratch tables: the only way in which these operators cut lineage.

Tables are written below the folder that the session names in ``spark.checkpoint.dir``,
which every executor and the driver share, so they survive the loss of any executor. Only
where the setting is absent and all runs on one machine (tests) a temporary folder is chosen.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import freeing_shuffles, shared_folder
from . import text as tx

#: Bytes of a batch of rows between Spark and Python, where Spark's default of 64 MB holds.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Ids are broadcast up to this many rows (16 MB); beyond, rows that can't match are told by a Bloom filter first.
BROADCAST_IDS = 1_000_000
#: Bits of a Bloom filter, at most (64 MB); 12 an id make one of some 300 others pass.
FILTER_BITS = 1 << 29


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def kept_columns(df: DataFrame, without: str | None, new: tuple[str, ...]) -> list[str]:
    """df's columns but ``without`` and those that the new ones replace, as they have a name of theirs."""
    gone = {n.lower() for n in (*new, *([without] if without else []))}
    return [c for c in df.columns if c.lower() not in gone]


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    """Four places of each id in a filter of a power of two of bits."""
    h = tx.mix64(ids.astype(np.int64).view(np.uint64))
    other = tx.mix64(h ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((h[:, None] + np.arange(4, dtype=np.uint64) * other[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def bloom_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of a table of ids; each bit range is made by a task of its own, so the driver takes the filter's size in, once."""
    piece = min(bits, 1 << 23)

    def places(batches):
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at // piece), pa.array(at)], names=["piece", "at"])

    def fill(batches):
        held: dict = {}
        for batch in batches:
            where = batch.column(0).to_numpy()
            for k in np.unique(where):
                held.setdefault(int(k), np.zeros(piece, bool))[batch.column(1).to_numpy()[where == k] % piece] = True
        rows = [(k, np.packbits(v).tobytes()) for k, v in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["piece", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    for r in ids.mapInArrow(places, "piece long, at long").repartition("piece").mapInArrow(fill, "piece long, bits binary").toLocalIterator():
        out[r.piece * piece // 8 : (r.piece + 1) * piece // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def by_ids(df: DataFrame, column: str, ids: DataFrame, how: str) -> DataFrame:
    """df joined (left_semi or left_anti) with a written table of ids, one column of longs without nulls.

    Few ids are broadcast. Of more, a Bloom filter is broadcast (64 MB at most), and only the
    rows that it lets through are shuffled to be joined; the others are known to have no match.
    """
    name = free_name(df, "__id")
    ids = ids.toDF(name)
    n = ids.count()
    if n <= BROADCAST_IDS:
        return df.join(F.broadcast(ids), df[column] == ids[name], how)
    bits = 1 << min(FILTER_BITS.bit_length() - 1, (12 * n - 1).bit_length())
    held = df.sparkSession.sparkContext.broadcast(bloom_filter(ids, bits))

    @F.arrow_udf("boolean")
    def maybe(x: pa.Array) -> pa.Array:
        at = _places(x.fill_null(0).to_numpy(zero_copy_only=False), bits)
        hit = (held.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return pa.array(hit.all(axis=1) & x.is_valid().to_numpy(zero_copy_only=False))

    flag = free_name(df, "__maybe")
    told = df.withColumn(flag, F.coalesce(maybe(F.col(column).cast("long")), F.lit(False)))
    met = told.where(F.col(flag)).drop(flag)
    met = met.join(ids, met[column] == ids[name], how)
    return met if how == "left_semi" else told.where(~F.col(flag)).drop(flag).unionByName(met)


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts pass to Python in batches of a few MB, unless the session says otherwise than by default."""
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


class Scratch:
    """A folder of written tables; ``drop`` removes one as soon as no later step reads it."""

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/terraloom/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        with freeing_shuffles(self.spark):
            df.write.option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)

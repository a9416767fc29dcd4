"""Written intermediate tables in the shared folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; one of this machine's only if all run on it and none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="terraloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed within frees its shuffle files when it has ended; the plans are executed once, so nothing reads them again."""
    before = spark.conf.get(_FREEING, "false")
    spark.conf.set(_FREEING, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREEING, before)


_scopes: list[list[WorkTables]] = []


@contextmanager
def dropped_at_end() -> Iterator[None]:
    """All work tables made within are removed at the end; what is to stay is written elsewhere before."""
    _scopes.append([])
    try:
        yield
    finally:
        for made in _scopes.pop():
            made.drop()


class WorkTables:
    """Tables that cut the lineage of iterative plans; they outlive the loss of executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/work/{name}-{uuid.uuid4().hex}"
        if _scopes:
            _scopes[-1].append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with freeing_shuffles(self.spark):
            df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads; without names all of them."""
        for path in [f"{self.root}/{name}" for name in names] or [self.root]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

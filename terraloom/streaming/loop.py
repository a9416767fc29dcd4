"""The incremental loop: one change file after the other, each an idempotent step.

State below ``root``: ``store`` (ORC entity table), ``index`` (closed dependency index),
``delta/seq=N`` (rows of step N that are not in the store yet), ``features/seq=N`` (its
GeoJSON). A step overwrites what it wrote before, adds only new edges to the index, and sees
the deltas of earlier steps only, so it can be repeated after a failure at any point.
Rows are ordered by edit time, then origin, then version; files may hold late edits.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.augment import augment, wanted
from ..operators.closure import new_index_edges, transitive_closure
from ..operators.edges import edges
from ..operators.history import all_histories
from ..operators.render import geojson, write_geojson
from ..schema import ENTITY
from ..scratch import WorkTables, dropped_at_end
from ..sources.changes import change_rows, read_changes
from ..sources.paths import fetched, numbers, path_of, with_retries
from ..sources.store import Index, WithEdges, lookup, merge_files, read_store, write_store

log = logging.getLogger(__name__)
_DELTA = StructType([*ENTITY.fields, StructField("seq", LongType())])


class Loop:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = 5, most_files: int = 16):
        """most_files: of a partition of the store, before a compaction merges them."""
        self.spark, self.root, self.compact_every, self.most_files = spark, root.rstrip("/"), compact_every, most_files
        self.index = Index(spark, f"{self.root}/index")

    def create(self, snapshot: DataFrame) -> None:
        """Store and index of a snapshot."""
        write_store(snapshot, f"{self.root}/store", "overwrite")
        self.index.replace(transitive_closure(edges(read_store(self.spark, f"{self.root}/store"))))
        self.spark.createDataFrame([], _DELTA).write.mode("overwrite").partitionBy("seq").parquet(f"{self.root}/delta")

    def _delta(self) -> DataFrame:
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/delta")
        if not fs.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs):
            return self.spark.createDataFrame([], _DELTA)
        return self.spark.read.schema(_DELTA).option("basePath", f"{self.root}/delta").parquet(f"{self.root}/delta")

    def step(self, seq: int, update: DataFrame) -> DataFrame:
        """Take in one file's rows; returns its features (type, id, mode, value), as they are below ``features``."""
        names = [f.name for f in ENTITY.fields]
        with dropped_at_end():
            tmp = WorkTables(self.spark, "step")
            update = tmp.keep(update.select(*names), "update")
            memory = self._delta().where(F.col("seq") < seq).select(*names)
            fresh = tmp.keep(new_index_edges(self.index, edges(update)), "edges")
            want = tmp.keep(wanted(WithEdges(self.index, fresh), update).distinct(), "wanted")
            rows = augment(update, memory, lookup(read_store(self.spark, f"{self.root}/store"), want), want)
            if log.isEnabledFor(logging.INFO):  # counting costs jobs
                rows = tmp.keep(rows, "rows")
                log.info("step %d: %d rows changed, %d index edges new, %d entities wanted, %d rows found", seq, update.count(), fresh.count(), want.count(), rows.count())
            made = tmp.keep(geojson(all_histories(rows)), "features")
            # State first, features last: a repeated step finds its own edges and delta and replaces them.
            update.write.mode("overwrite").parquet(f"{self.root}/delta/seq={seq}")
            self.index.append(fresh)
            write_geojson(made, f"{self.root}/features/seq={seq}")
        about = F.from_json("value", "properties STRUCT<type: STRING, id: BIGINT, visible: BOOLEAN>")["properties"]
        lines = self.spark.read.text(f"{self.root}/features/seq={seq}").select("value", about.alias("p"))
        return lines.select("p.type", "p.id", F.when(F.col("p.visible"), "in").otherwise("before").alias("mode"), "value")

    def _taken(self, seq: int) -> None:
        """Called after each step of a run or stream: every ``compact_every`` steps the deltas go to the store."""
        if seq % self.compact_every == 0:
            self.compact(seq)

    def compact(self, upto: int) -> None:
        """Move the deltas of steps up to ``upto`` into the store, and merge partitions of many files.

        A repeated row is harmless, as rows are told apart by key and version.
        """
        delta = self._delta().where(F.col("seq") <= upto)
        done = [r.seq for r in delta.select("seq").distinct().collect()]
        if not done:
            return
        write_store(delta.drop("seq"), f"{self.root}/store", "append")
        conf = self.spark._jsc.hadoopConfiguration()
        for seq in done:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/delta/seq={seq}")
            path.getFileSystem(conf).delete(path, True)
        merge_files(self.spark, f"{self.root}/store", self.most_files)

    def _file(self, seq: int, path: str, **again) -> None:
        """A step over one change file, tried again while it can't be read; remote files are copied to the shared folder."""
        with dropped_at_end():
            tmp = WorkTables(self.spark, "file")
            read = lambda: tmp.keep(read_changes(self.spark, fetched(self.spark, path, f"{tmp.root}/copy")), f"rows-{uuid.uuid4().hex}")
            self.step(seq, with_retries(read, **({"errors": (Exception,)} | again)))
        self._taken(seq)

    def run(self, template: str, start: int, end: int, attempts: int = 9, sleep: Callable | None = None) -> int:
        """Steps start..end (end -1: for ever) over numbered change files; number of steps taken.

        A file that can't be read after all attempts raises; it is never skipped.
        """
        done = 0
        for seq in numbers(start, end):
            self._file(seq, path_of(template, seq), **({"attempts": attempts} | ({"sleep": sleep} if sleep else {})))
            done += 1
        return done

    def follow(self, template: str, start: int, checkpoint: str, end: int = -1, interval: str = "1 seconds"):
        """A streaming query over numbered change files as they appear, in order, a step for each."""
        from .source import NumberedFiles

        self.spark.dataSource.register(NumberedFiles)
        numbered = self.spark.readStream.format("numbered_files").options(template=template, start=str(start), end=str(end)).load()

        def batch(df: DataFrame, _: int) -> None:
            for r in df.orderBy("number").collect():  # one number
                self._file(r.number, r.path)

        return numbered.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()

    def stream(self, files: DataFrame, checkpoint: str, first: int = 1):
        """A streaming query over parsed change files (streaming frame of create, modify, delete), a step for each micro-batch."""

        def batch(df: DataFrame, batch_id: int) -> None:
            self.step(first + batch_id, change_rows(df))
            self._taken(first + batch_id)

        return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def change_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Change files of a folder as a stream, one a batch, oldest first."""
    from ..sources.changes import CHANGE_FILE

    reader = spark.readStream.format("xml").option("rowTag", "osmChange").option("maxFilesPerTrigger", 1).schema(CHANGE_FILE)
    return reader.load(folder)

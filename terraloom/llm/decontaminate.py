"""Benchmark decontamination by size-partitioned MinHash containment search.

Words are runs of letters, digits, apostrophes and non-ASCII characters, A-Z lower-cased,
so punctuation and spacing do not matter. An item's shingles are runs of five words (of all
its words, if it has fewer). A document holds an item if it contains at least 80% of the
item's distinct shingles.

Items are partitioned by shingle width and by the power of two of their set size. For each
partition a document's shingles are cut into overlapping windows of twice the partition's upper
size, one beginning every upper size, so that a passage as long as an item lies within one
window, whose set is of the item's order of size whatever the document's length. Windows and
items are sketched by ``hashes`` MinHash functions; as a window may share no more than a fifth
with an item it holds, a band is one row, and one agreeing value makes a candidate.

So that no item is lost to chance, or because its shingles are scattered over a document,
documents are probed as well with each item's smallest values of one more function, as many as
the partition's upper size needs for a guarantee: a set that contains the share t of n shingles
misses at most (1 - t) * n of them, so it contains one of any floor((1 - t) * n) + 1. Every
candidate of either side with enough shingles at all is verified by counting the item's exact
shingles in the document.

Items are taken in blocks of bounded size, each broadcast and held against all documents;
so neither the benchmark nor the corpus has a size limit. Null, empty and word-less texts
contain nothing; such items are contained in nothing. Repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from . import text as tx
from .runtime import Scratch, by_ids
from .toxicity import GAP


@dataclass(frozen=True)
class ContainmentParams:
    width: int = 5
    percent: int = 80  # of an item's shingles
    hashes: int = 16  # of a sketch
    block_shingles: int = 1_000_000  # of the items broadcast at a time


def needed(n: int, percent: int) -> int:
    """Shingles of an item of n that a document must contain."""
    return max(1, -(-n * percent // 100))


def sketch_size(n: int, percent: int) -> int:
    """MinHash values kept of an item of n shingles, from the upper bound of its size partition."""
    upper = (1 << n.bit_length()) - 1
    return min(n, upper - needed(upper, percent) + 1)


def minhashes(s: np.ndarray, hashes: int) -> np.ndarray:
    """Values of each shingle by each function, one row a function."""
    with np.errstate(over="ignore"):
        odd = tx.mix64(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
        return s[None, :] * odd[:, None]


def window_sketches(values: np.ndarray, upper: int) -> np.ndarray:
    """Sketches (a column each) of the windows of 2 * upper shingles, one beginning every upper; values: those of the shingles in order."""
    blocks = np.minimum.reduceat(values, np.arange(0, values.shape[1], upper), axis=1)
    return np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks


def _band_keys(sketches: np.ndarray) -> np.ndarray:
    return tx.mix64(sketches ^ tx.mix64(np.arange(1, len(sketches) + 1, dtype=np.uint64))[:, None])


class ItemBlock:
    """Some items' shingle sets, with their sketches by size partition and the smallest values of each as probes."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], p: ContainmentParams):
        """items: (position, shingle width, sorted distinct shingles)."""
        self.p = p
        self.widths = sorted({w for _, w, _ in items})
        self.by_width = {}
        for w in self.widths:
            own = [(i, s) for i, k, s in items if k == w]
            parts: dict[int, tuple[list, list]] = {}
            probes = []
            for j, (_, s) in enumerate(own):
                least = s[np.argsort(tx.mix64(s ^ np.uint64(0x1D8E4E27C47D124F)), kind="stable")[: sketch_size(len(s), p.percent)]]
                probes.append((least, np.full(len(least), j)))
                keys, of = parts.setdefault(1 << len(s).bit_length(), ([], []))
                keys.append(_band_keys(minhashes(s, p.hashes).min(axis=1, keepdims=True)).ravel())
                of.append(np.full(p.hashes, j))
            self.by_width[w] = (own, *self._sorted(*zip(*probes, strict=True)), {u: self._sorted(*x) for u, x in sorted(parts.items())})

    @staticmethod
    def _sorted(keys, of) -> tuple[np.ndarray, np.ndarray]:
        keys, of = np.concatenate(keys), np.concatenate(of)
        order = np.argsort(keys, kind="stable")
        return keys[order], of[order]

    @staticmethod
    def _hits(keys: np.ndarray, of: np.ndarray, asked: np.ndarray) -> set[int]:
        lo = np.searchsorted(keys, asked)
        hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == asked)
        hi = np.searchsorted(keys, asked[hit], side="right")
        return {int(j) for a, b in zip(lo[hit], hi, strict=True) for j in of[a:b]}

    def sketched(self, words: np.ndarray, w: int) -> set[int]:
        """Candidates by the sketches of the document's windows: positions among the items of this width."""
        stream = tx.shingle_stream(words, w)
        values = minhashes(stream, self.p.hashes)
        return {j for u, (keys, of) in self.by_width[w][3].items() for j in self._hits(keys, of, _band_keys(window_sketches(values, u)).ravel())}

    def find(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item position, shared shingles, item's shingles) of the items that a document contains."""
        found = []
        for w in self.widths:
            if len(words) < w:
                continue
            own, keys, of, _ = self.by_width[w]
            s = tx.distinct(tx.shingle_stream(words, w))
            for j in sorted(self.sketched(words, w) | self._hits(keys, of, s)):
                item, grams = own[j]
                if len(s) < needed(len(grams), self.p.percent):
                    continue
                common = int(np.count_nonzero(s[np.minimum(np.searchsorted(s, grams), len(s) - 1)] == grams))
                if 100 * common >= self.p.percent * len(grams):
                    found.append((item, common, len(grams)))
        return found


def _item_sets(p: ContainmentParams):
    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                words = tx.tokens(t.as_py(), GAP)[0]
                w = min(p.width, len(words))
                rows.append((w, tx.distinct(tx.shingle_stream(words, w)).tobytes() if w else b""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "w", "grams"])

    return run


def contained_items(docs: DataFrame, items: DataFrame, p: ContainmentParams = ContainmentParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment), one row for each document and item it contains."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "decontaminate")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("t")).mapInArrow(_item_sets(p), "item_id long, w int, grams binary").where("w > 0")
    schema = StructType([*src.schema.fields[:1], StructField("item_id", src.schema["doc_id"].dataType), StructField("shared", IntegerType()), StructField("item_shingles", IntegerType()), StructField("containment", DoubleType())])

    def scan(block: list) -> DataFrame:
        ids = [r.item_id for r in block]
        held = spark.sparkContext.broadcast(ItemBlock([(i, r.w, np.frombuffer(r.grams, np.uint64)) for i, r in enumerate(block)], p))

        def run(batches):
            for batch in batches:
                out = [(d.as_py(), ids[i], n, m, n / m) for d, t in zip(batch.column(0), batch.column(1), strict=True) for i, n, m in held.value.find(tx.tokens(t.as_py(), GAP)[0])]
                cols = list(zip(*out, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

        return src.mapInArrow(run, schema), held

    parts, block, size = [], [], 0
    for r in sets.toLocalIterator():  # one block at a time is on the driver
        block.append(r)
        size += len(r.grams) // 8
        if size >= p.block_shingles:
            found, held = scan(block)
            parts.append(tmp.write(found, f"block-{len(parts)}"))
            held.destroy()
            block, size = [], 0
    if block or not parts:
        parts.append(scan(block)[0] if block else spark.createDataFrame([], schema))
    return reduce(DataFrame.unionByName, parts)


def without_contaminated(docs: DataFrame, items: DataFrame, p: ContainmentParams = ContainmentParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that contain a benchmark item; null ids stay; of documents with one id all go if one contains an item."""
    tmp = Scratch(docs.sparkSession, "decontaminate-keep")
    found = tmp.write(contained_items(docs, items, p, id_col, text_col).where("doc_id IS NOT NULL").select("doc_id").distinct(), "found")
    return by_ids(docs, id_col, found, "left_anti")

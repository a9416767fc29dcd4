"""MinHash near-duplicate detection.

1. Each document's distinct shingles are sketched by *fast similarity sketching*: rounds
   0..t-1 throw every shingle into a hashed bin, rounds t..2t-1 throw all of them into bin
   ``round - t``. A bin keeps its smallest (round, hash) pair, so every coordinate is
   filled after at most 2t rounds, and the share of agreeing coordinates of two sketches is
   an unbiased, concentrated estimate of their Jaccard similarity.
2. Equal shingle sets form one class (128-bit digest), so copies are never paired.
3. Sketches are cut into bands; classes that agree on a band share a bucket. For the
   documents of shared buckets the shingles are counted that no other of them has: two
   documents have at most the other shingles in common, an exact bound that spares most
   checks among variants of one text that are not close enough to one another. The member
   with the smallest share of such own shingles, the one most like what the bucket's texts
   come from, is the bucket's centre, and every member is checked against it, never all
   pairs of a group; then those left out once more among themselves.
4. Links are confirmed on the full shingle sets and components found by alternating
   large-star / small-star rounds. Buckets that still hold several components are then
   finished by a prefix join of their members' rarest shingles, which finds every link
   between them, and its pairs are confirmed as well. A component is therefore complete with
   respect to the banding, whatever a bucket's size.

Null, empty or blank text: an empty set, linked with nothing, a component of its own.
Null ``doc_id``: the row is returned with null component and ``kept`` false, and takes no
part in linking. Rows that share a ``doc_id`` count as one document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import text as tx
from .components import connected_components
from .grouping import fold_groups
from .runtime import Scratch, by_ids, free_name

U64 = np.uint64
EMPTY = U64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class NearDupParams:
    width: int = 2  # words in a shingle
    percent: int = 80  # link if 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 6

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def sketch(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: one uint64 per bin."""
    out = np.full(bins, EMPTY, dtype=U64)
    n, rnd = len(hashes), 0
    while rnd < 2 * bins:
        k = max(1, min(2 * bins - rnd, (2 * bins) // n)) if n < bins else 1
        rounds = np.arange(rnd, rnd + k, dtype=U64)
        with np.errstate(over="ignore"):
            h = tx.mix64(hashes[None, :] ^ tx.mix64((rounds + U64(1)) * U64(0xA0761D6478BD642F))[:, None])
        at = np.where(rounds[:, None] < bins, h % U64(bins), rounds[:, None] - U64(bins)).astype(np.int64).ravel()
        value = ((rounds[:, None] << U64(48)) | (h >> U64(16))).ravel()
        order = np.argsort(value)[::-1]
        first = np.full(bins, EMPTY, dtype=U64)
        first[at[order]] = value[order]  # the last write, that of the smallest value, stays
        np.minimum(out, first, out=out)
        rnd += k
        if (out != EMPTY).all():
            break
    return out


def band_keys(sk: np.ndarray, p: NearDupParams) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = tx.mix64(np.arange(1, p.bands + 1, dtype=U64) * U64(0xE7037ED1A0B428DB))
        for col in sk.reshape(p.bands, p.rows).T:
            key = tx.mix64(key ^ col)
    return key.view(np.int64)


def _signatures(p: NearDupParams):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 1000):
                n, s1, s2, keys = [], [], [], []
                for t in batch.column(1).slice(at, 1000):
                    s = tx.shingle_set(t.as_py(), p.width)
                    n.append(len(s))
                    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64)
                    s1.append(int(d[0]))
                    s2.append(int(d[1]))
                    keys.append(band_keys(sketch(s, p.bins), p) if len(s) else None)
                yield pa.RecordBatch.from_arrays([ids.slice(at, 1000), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    return run


def _sets(p: NearDupParams):
    schema = pa.schema([("id", pa.int64()), ("grams", pa.binary())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([tx.shingle_set(t.as_py(), p.width).tobytes() for t in part.column(1)], pa.binary())], schema=schema)

    return run


def _own_shingles(sets: DataFrame) -> DataFrame:
    """(rep, own): how many shingles each document has that no other document of sets has."""

    def run(batches):
        for batch in batches:
            for i, g in zip(batch.column(0), batch.column(1), strict=True):
                grams = np.frombuffer(g.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.full(len(grams), i.as_py()))], names=["gram", "id"])

    single = sets.mapInArrow(run, "gram long, id long").groupBy("gram").agg(F.count("*").alias("m"), F.min("id").alias("rep")).where("m = 1")
    return single.groupBy("rep").agg(F.count("*").alias("own"))


#: Smallest set size of each size class: one class a size up to 64, then steps of 2%.
_CLASSES = np.arange(0, 65).tolist()
while _CLASSES[-1] < 1 << 40:
    _CLASSES.append(max(_CLASSES[-1] + 1, _CLASSES[-1] * 102 // 100))
_CLASSES = np.array(_CLASSES)


def prefix_keys(grams: np.ndarray, df: np.ndarray, p: NearDupParams) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of a set as the larger and as the smaller one of a pair.

    Sets of n and m shingles are linked only if they share o = ceil(percent * (n + m) / (100 +
    percent)); so of their shingles in one order, the rarest first, the first n - o + 1 and
    m - o + 1 have one in common. m is known by its size class only, hence a key for each
    such shingle and each pair of size classes. Shingles of no other set need no key.
    """
    n = len(grams)
    order = np.lexsort((grams, df))
    grams, lone = grams[order].view(U64), int(np.count_nonzero(df == 1))
    own = int(np.searchsorted(_CLASSES, n, side="right")) - 1

    def keys(lo: int, hi: int, larger: bool) -> np.ndarray:
        out = [np.empty(0, U64)]
        for c in range(int(np.searchsorted(_CLASSES, lo, side="right")) - 1, int(np.searchsorted(_CLASSES, hi, side="right"))):
            least = max(int(_CLASSES[c]), lo)
            take = n - -(-p.percent * (n + least) // (100 + p.percent)) + 1
            pair = (own << 20 | c) if larger else (c << 20 | own)
            out.append(tx.mix64(grams[lone : max(take, lone)] ^ tx.mix64(np.array([pair + 1], U64))))
        return np.concatenate(out).view(np.int64)

    return keys(-(-n * p.percent // 100), n, True), keys(n, n * 100 // p.percent, False)


def _meetings(rest: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """(x, nx, lx, y, ny, ly): what meets in the prefix join, the larger set first, once for each key."""
    nodes = rest.groupBy("rep").agg(F.first("label").alias("label"), F.max(F.col("label") != F.col("main")).alias("out"))

    def run(batches):
        for batch in batches:
            for i, g in zip(batch.column(0), batch.column(1), strict=True):
                grams = np.frombuffer(g.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), i.as_py())), pa.array(grams)], names=["id", "gram"])

    flat = sets.join(nodes.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "grams").mapInArrow(run, "id long, gram long").distinct()
    counted = flat.join(flat.groupBy("gram").agg(F.count("*").alias("df")), "gram").select("id", "gram", "df")

    def fold(state, part):
        state[0].append(part.column(1).to_numpy())
        state[1].append(part.column(2).to_numpy())
        return state

    def finish(i, state):
        grams = np.concatenate(state[0])
        larger, smaller = prefix_keys(grams, np.concatenate(state[1]), p)
        return i, len(grams), larger.tolist(), smaller.tolist()

    schema = StructType([StructField("rep", LongType()), StructField("n", LongType()), StructField("larger", ArrayType(LongType())), StructField("smaller", ArrayType(LongType()))])
    keyed = fold_groups(counted, "id", lambda: ([], []), fold, finish, schema, flush=500).join(nodes, "rep")
    x = keyed.select(F.explode("larger").alias("key"), F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("label").alias("lx"), F.col("out").alias("ox"))
    y = keyed.select(F.explode("smaller").alias("key"), F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("label").alias("ly"), F.col("out").alias("oy"))
    # One of a pair is outside its bucket's largest component; members of that one never meet each other, so a key costs its members times its outsiders.
    return x.where("ox").join(y, "key").unionByName(x.where("NOT ox").join(y.where("oy"), "key"))


def _open_pairs(rest: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """(a, b): pairs of members of the open buckets, in different components, that may be linked; every link is among them.

    rest: (rep, label, main) of the members. A prefix join on the rarest shingles: variants
    of one text that have too many shingles of their own don't meet, however many they are.
    """
    once = (F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    met = _meetings(rest, sets, p).where((F.col("lx") != F.col("ly")) & once)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _confirm(p: NearDupParams):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b, left, right = batch.columns
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), dtype=U64), np.frombuffer(right[i].as_buffer(), dtype=U64)
                if len(x) > len(y):
                    x, y = y, x
                common = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                keep[i] = 100 * common >= p.percent * (len(x) + len(y) - common)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], schema=schema)

    return run


def near_duplicates(docs: DataFrame, p: NearDupParams = NearDupParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of docs."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "neardup")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = tmp.write(src.mapInArrow(_signatures(p), "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"), "sig")

    linked = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = tmp.write(linked.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")), "classes")
    reps = linked.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).where("doc_id = rep")
    band = reps.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    shared = band.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    buckets = tmp.write(band.join(shared, "key", "left_semi"), "buckets")

    wanted = tmp.write(buckets.select("rep").distinct(), "wanted")
    sets = tmp.write(by_ids(src, "doc_id", wanted, "left_semi").mapInArrow(_sets(p), "id long, grams binary"), "sets", "lz4")
    members = tmp.write(buckets.join(_own_shingles(sets), "rep", "left").select("key", "rep", "n", F.coalesce("own", F.lit(0)).alias("own")), "members")
    tmp.drop("buckets")

    def possible(x: str, y: str) -> Column:
        """Whether two documents can be linked: they can't share shingles that one of them has alone."""
        most = F.least(F.col(f"n{x}") - F.col(f"o{x}"), F.col(f"n{y}") - F.col(f"o{y}"))
        return most * 100 >= (F.col(f"n{x}") + F.col(f"n{y}") - most) * p.percent

    def side(df: DataFrame, x: str, *more: str) -> DataFrame:
        return df.select("key", F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("own").alias(f"o{x}"), *more)

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def stars(of: DataFrame) -> DataFrame:
        """Pairs of each bucket's centre and its other members; the centre has the smallest share of own shingles."""
        rank = F.floor(F.col("own") * (1 << 20) / F.col("n")) * (1 << 40) + F.pmod(F.xxhash64("rep"), F.lit(1 << 40))
        ranked = of.withColumn("rank", rank)
        least = ranked.groupBy("key").agg(F.min("rank").alias("rank"))
        centre = side(ranked.join(least, ["key", "rank"], "left_semi"), "x")
        return ordered(side(of, "y").join(centre, "key").where((F.col("x") != F.col("y")) & possible("x", "y")))

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        return tmp.write(both.select("a", "b", "ga", "gb").mapInArrow(_confirm(p), "a long, b long").distinct(), name)

    def labelled(labels: DataFrame, name: str) -> DataFrame:
        """Members of the buckets that still hold several components, with their label and that of the bucket's largest one by id."""
        own = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        size = own.groupBy("key", "label").agg(F.count("*").alias("m"))
        main = size.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("label", F.struct("m", "label")).alias("main")).where("parts > 1").select("key", "main")
        return tmp.write(own.join(main, "key").select("key", "rep", "n", "own", "label", "main"), name)

    def joined(labels: DataFrame | None, pairs: DataFrame, name: str) -> DataFrame:
        """Labels after the confirmed ones of pairs are added: old components count as one edge for each node."""
        links = confirmed(pairs, f"links-{name}")
        if labels is not None:
            if not links.limit(1).count():
                return labels
            links = links.unionAll(labels.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b")))
        return connected_components(links, tmp, f"cc-{name}")

    checked = tmp.write(stars(members), "stars-1")
    labels = joined(None, checked, "1")
    rest = labelled(labels, "rest-1")
    # Once more among those that a bucket's first star has left out.
    again = tmp.write(stars(rest.where("label <> main")).join(checked, ["a", "b"], "left_anti"), "stars-2")
    checked = checked.unionByName(again)
    labels = joined(labels, again, "2")
    rest = labelled(labels, "rest-2")
    # What the stars left open: links between components of one bucket, found exactly.
    last = tmp.write(_open_pairs(rest, sets, p).join(checked, ["a", "b"], "left_anti"), "open")
    labels = joined(labels, last, "3")
    tmp.drop("members", "rest-1", "rest-2", "sets")

    final = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("s1", "s2", F.coalesce("label", "rep").alias("label"))
    out = sig.select("doc_id", "n_shingles", "s1", "s2").join(final, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("label"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, p: NearDupParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the near duplicates: of each component the row with the smallest id stays, once.

    Rows with a null id stay, as nothing can be said about them.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark, "neardup-keep")
    flat = tmp.write(near_duplicates(docs, p, id_col, text_col).groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "verdict")
    gone = tmp.write(flat.where("doc_id IS NOT NULL AND NOT kept").select("doc_id"), "gone")
    again = tmp.write(flat.where("doc_id IS NOT NULL AND kept AND n > 1").select("doc_id"), "again")
    left = by_ids(docs, id_col, gone, "left_anti")
    if not again.limit(1).count():
        return left
    once, twice = by_ids(left, id_col, again, "left_anti"), by_ids(left, id_col, again, "left_semi")
    first, rank = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last()), free_name(docs, "__rank")
    return once.unionByName(twice.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank))

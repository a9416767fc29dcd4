"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search.

Equal vectors form one node of the graph; the (bounded) number of copies that an answer can
hold is put back at the end. Vectors of one length are split into ranges of norms (a factor of
two each), scaled within their range and given one more coordinate that makes their norms
equal, so that cosine neighbours make a graph for each range on which inner products can be
searched. Node vectors are in single precision, products and sums in double.

Build: every vector joins the leaf of its nearest pivot (several trees of them); leaves that
are too large are split again by pivots of their own. Its best neighbours within its leaves
are its first list. Then NN-descent rounds: a node brings together a sample of its neighbours
and reverse neighbours and compares these, neighbours of neighbours, with one another, where
one of the two is new in its list since it was last brought together; pairs that improve on
a list are merged into it. Only ids are joined until the sample is chosen. The rounds go on
until hardly any entry of the lists changes. Then the lists of a bounded sample of nodes are
held against all vectors; while they lack too many of the true nearest, more trees and rounds
follow (``most_turns`` times at most), so that recall doesn't fall as vectors get more.
Search, for each query and range of norms: from the query's own node and the best of a bounded
sample of the range, a query expands the best ``expand`` nodes it knows that it has not
expanded yet: a join of ids with the lists of neighbours and reverse neighbours, less what the query has seen, and only
then a join with the vectors. It stops when the best ``expand`` it knows are all expanded. What
it remembers and rounding could have kept from the answer is scored again in double precision
on the original vectors.

Before every shuffle by node the rows of a node are reduced within their batch, and states of
groups are folded as rows pass by, so a node that is a neighbour of very many others neither
sends nor holds more than a bounded list in any batch.

Vectors that are null, empty, zero or hold null or non-finite components, and null ids, take no
part. Vectors of different lengths are never compared: each is searched among its own length.
Rows that repeat both id and vector count once. An id with several vectors has an answer for
each of them, and occurs in an answer once, with its best score. No list of nodes is ever on
the driver but the pivots and the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from . import text as tx
from .runtime import Scratch


@dataclass(frozen=True)
class AnnParams:
    neighbours: int = 64  # of a node in the graph
    sampled: int = 16  # new neighbours, new reverse neighbours, and old ones of either kind, that a node brings together in a round
    settled: float = 0.02  # rounds end when a smaller share of the lists' entries changed in one
    trees: int = 8  # sets of pivots at a time
    aim: float = 0.9  # share of the true nearest that the lists of checked nodes are to hold, or as many sets of pivots more are taken
    checked: int = 128  # nodes, held against all others
    most_turns: int = 8  # times that sets of pivots are taken at most
    leaf: int = 256  # vectors of a pivot, about
    leaf_best: int = 24  # neighbours that a node takes from a leaf
    most_pivots: int = 4096  # of one leaf
    level_pivots: int = 65536  # of all leaves that are split at once
    most_leaf: int = 1024  # larger leaves are split
    stuck: int = 6  # leaves of equal vectors (in single precision), which so many splits left too large, are dealt into parts at random
    expand: int = 32  # a query stops when so many of the best nodes it knows are expanded
    beam: int = 64  # nodes that a query remembers
    rounding: float = 2.0**-22  # of a score before it is made again on the original vectors, where products are below 1
    entries: int = 256  # sampled nodes of a range of norms
    starts: int = 8  # of these, where a query starts
    top: int = 20


#: Ranges of norms are numbered by their power of two; smaller norms are in the first range.
LEAST_PART = -500

#: Marks of a list's entries: brought together before, not yet, and not yet and found in the round that wrote the list.
OLD, NEW, FOUND = 0, 1, 3

_LIST = StructType([StructField("id", LongType()), StructField("nb", BinaryType()), StructField("sim", BinaryType()), StructField("mark", BinaryType())])
_GRAPH = StructType([*_LIST.fields, StructField("changed", LongType())])
_STATE = StructType([StructField("k", LongType()), StructField("raw", BinaryType()), StructField("ids", BinaryType()), StructField("scores", BinaryType()), StructField("done", BinaryType()), StructField("seen", BinaryType())])


# --- columns of Arrow batches as arrays --------------------------------------------------------


def _values(col: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column without nulls, and how many each row has."""
    if not len(col):
        return np.empty(0, kind), np.empty(0, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if col.buffers()[2] else np.empty(0, np.uint8)
    return data.copy().view(kind), np.diff(offsets) // np.dtype(kind).itemsize


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows are the next counts[i] values."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _vectors(col: pa.Array) -> np.ndarray:
    return _values(col, np.float32)[0].reshape(len(col), -1).astype(float)


def _starts(keys: np.ndarray) -> np.ndarray:
    """First position of each run of equal keys, and the end."""
    return np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)) if len(keys) else np.zeros(1, np.int64)


def _rank(keys: np.ndarray) -> np.ndarray:
    """Position of each element within its run of equal keys."""
    at = _starts(keys)
    return np.arange(len(keys)) - np.repeat(at[:-1], np.diff(at))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by the first column, in batches that don't part a group (of bounded size)."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if left is not None:
            batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        cut = int(_starts(batch.column(0).to_numpy())[-2])
        if cut:
            yield batch.slice(0, cut)
        left = batch.slice(cut)
    if left is not None:
        yield left


# --- neighbour lists ---------------------------------------------------------------------------


def _best(flat: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """(id, nb, sim, mark) rows: the k greatest sims of each id, best first; a repeated pair counts once, with its oldest mark."""
    ids, nb, sim, mark = flat
    order = np.lexsort((mark, nb, ids))
    ids, nb, sim, mark = ids[order], nb[order], sim[order], mark[order]
    if len(ids):
        once = np.append(True, (ids[1:] != ids[:-1]) | (nb[1:] != nb[:-1]))
        ids, nb, sim, mark = ids[once], nb[once], sim[once], mark[once]
    order = np.lexsort((nb, -sim, ids))
    order = order[_rank(ids[order]) < k]
    return ids[order], nb[order], sim[order], mark[order]


def _to_lists(flat: tuple[np.ndarray, ...], changed: bool = False) -> pa.RecordBatch:
    """Flat rows, those of an id together, as one list an id."""
    ids, nb, sim, mark = flat
    at = _starts(ids)
    counts = np.diff(at)
    cols = [pa.array(ids[at[:-1]], pa.int64()), _packed(nb, counts), _packed(sim, counts), _packed(mark, counts)]
    if changed:
        found = np.add.reduceat((mark == FOUND).astype(np.int64), at[:-1]) if len(ids) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([*cols, pa.array(found, pa.int64())], names=_GRAPH.names)
    return pa.RecordBatch.from_arrays(cols, names=_LIST.names)


def _to_flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    nb, counts = _values(batch.column(1), np.int64)
    return np.repeat(batch.column(0).to_numpy(), counts), nb, _values(batch.column(2), np.float64)[0], _values(batch.column(3), np.uint8)[0]


def _folded(df: DataFrame, key: str, schema: StructType, flat: Callable, fold: Callable, rows: Callable) -> DataFrame:
    """df's rows reduced for each key by fold, which may be applied again to what it made with more rows; memory: a batch and a group's reduced rows."""

    def run(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = flat(batch)
            if kept is not None:
                now = tuple(np.concatenate(x) for x in zip(kept, now, strict=True))
            now = fold(now)
            if len(now[0]):
                last = now[0] == now[0][-1]
                kept = tuple(x[last] for x in now)
                yield rows(tuple(x[~last] for x in now))
        if kept is not None:
            yield rows(kept)

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def _merge_lists(df: DataFrame, k: int) -> DataFrame:
    """Lists, several for an id, as one list of the k best; changed: how many of them were found now."""
    return _folded(df, "id", _GRAPH, _to_flat, lambda f: _best(f, k), lambda f: _to_lists(f, True))


def _split(nodes: DataFrame, tmp: Scratch, p: AnnParams, salt: int) -> DataFrame:
    """(leaf, id, vec): the leaves of all trees; another salt makes others."""
    trees = F.explode(F.array(*[F.lit(t).cast("long") for t in range(p.trees)]))
    dealt = nodes.select("part", trees.alias("tree"), "id", "vec").select((p.trees * (F.col("part") - LEAST_PART) + F.col("tree")).alias("leaf"), "id", "vec")
    name, following, tries = "", p.trees << 12, {}
    while True:
        # At most n / most_leaf leaves are too large; those that are split at once have level_pivots together.
        large = dealt.groupBy("leaf").count().where(F.col("count") > p.most_leaf).orderBy(F.desc("count"), "leaf").limit(p.level_pivots // 2).collect()
        large = [(r.leaf, r["count"]) for r in large if tries.get(r.leaf, 0) < p.stuck]
        wanted, total = {}, 0
        for leaf, n in large:
            k = min(p.most_pivots, -(-n // p.leaf))
            if total + k <= p.level_pivots:
                wanted[leaf], total = k / n, total + k
        if not wanted:
            break
        share = nodes.sparkSession.createDataFrame(list(wanted.items()), "leaf long, share double")
        chance = F.pmod(F.xxhash64("id", "leaf", F.lit(following), F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
        found: dict = {}
        for r in dealt.join(F.broadcast(share), "leaf").where(chance < F.col("share")).orderBy("leaf", "id").select("leaf", "vec").collect():
            found.setdefault(r.leaf, []).append(np.frombuffer(r.vec, np.float32))
        split = {}
        for leaf in wanted:
            tries[leaf] = tries.get(leaf, 0) + 1
            if len(found.get(leaf, [])) > 1:
                c = np.stack(found[leaf]).astype(float)
                middle = c.mean(axis=0)
                c -= middle
                split[leaf] = (following, middle, c.T, (c * c).sum(axis=1) / 2)
                tries.update(dict.fromkeys(range(following, following + len(c)), tries[leaf]))
                following += len(c)
        share_out = nodes.sparkSession.sparkContext.broadcast(split)

        def assign(batches, share_out=share_out):
            split = share_out.value
            for batch in batches:
                if batch.num_rows:
                    before = batch.column(0).to_numpy()
                    leaf, x = before.copy(), _vectors(batch.column(2))
                    for one in np.unique(before):
                        if one in split:
                            first, middle, c, half = split[one]
                            at = np.flatnonzero(before == one)
                            for k in range(0, len(at), 512):
                                some = at[k : k + 512]
                                leaf[some] = first + np.argmax((x[some] - middle) @ c - half, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *batch.columns[1:]], names=["leaf", "id", "vec"])

        before, name = name, f"leaves-{following}"
        dealt = tmp.write(dealt.mapInArrow(assign, "leaf long, id long, vec binary"), name, "lz4")
        if before:
            tmp.drop(before)
        share_out.unpersist()
    parts = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / p.most_leaf).alias("parts")).where("parts > 1")
    dealt = dealt.join(F.broadcast(parts), "leaf", "left")
    return dealt.select((F.col("leaf") * (1 << 32) + F.pmod(F.xxhash64("id", F.lit(5)), F.coalesce("parts", F.lit(1)))).alias("leaf"), "id", "vec")


def _leaf_lists(nodes: DataFrame, tmp: Scratch, p: AnnParams, salt: int) -> DataFrame:
    """The best neighbours within each leaf of each tree, a list for each."""

    def run(batches):
        for batch in _whole_groups(batches):
            ids, x, at = batch.column(1).to_numpy(), _vectors(batch.column(2)), _starts(batch.column(0).to_numpy())
            for a, b in zip(at[:-1], at[1:], strict=True):
                own, k = ids[a:b], min(p.leaf_best, b - a - 1)
                s = x[a:b] @ x[a:b].T
                np.fill_diagonal(s, -np.inf)
                best = np.argpartition(-s, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((b - a, 0), np.int64)
                counts, n = np.full(b - a, k), (b - a) * k
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), _packed(own[best].ravel(), counts), _packed(np.take_along_axis(s, best, 1).ravel(), counts), _packed(np.full(n, FOUND, np.uint8), counts)], names=_LIST.names)

    return _split(nodes, tmp, p, salt).repartition("leaf").sortWithinPartitions("leaf").mapInArrow(run, _LIST)


def _priority(v: np.ndarray, u: np.ndarray, salt: int) -> np.ndarray:
    return tx.mix64(u.view(np.uint64) ^ tx.mix64(v.view(np.uint64) ^ tx.mix64(np.array([salt], np.uint64))))


def _chosen(v: np.ndarray, u: np.ndarray, new: np.ndarray, each: int, salt: int) -> np.ndarray:
    """Positions of each new and each old u of a v, by hash; a repeated pair counts once, as new if it is."""
    order = np.lexsort((~new, u, v))
    order = order[np.append(True, (v[order][1:] != v[order][:-1]) | (u[order][1:] != u[order][:-1]))] if len(v) else order
    order = order[np.lexsort((_priority(v[order], u[order], salt), ~new[order], v[order]))]
    group = tx.mix64(v[order].view(np.uint64)) ^ new[order]
    return order[_rank(group) < each]


def _both_ways(graph: DataFrame, each: int, salt: int, aged: bool = True) -> DataFrame:
    """(v, u, new): of each node v up to ``each`` neighbours and as many reverse neighbours u, new ones and as many old ones; nodes without a new one have none. Unless aged all count as new."""

    def pairs(v, u, new, back):
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(u, pa.int64()), pa.array(new, pa.bool_()), pa.array(back, pa.bool_())], names=["v", "u", "new", "back"])

    def run(batches):
        for batch in batches:
            v, u, _, mark = _to_flat(batch)
            mark = mark if aged else np.full_like(mark, NEW)
            at = _chosen(v, u, mark > 0, each, salt)
            v, u, new = v[at], u[at], mark[at] > 0
            at = _chosen(u, v, new, each, salt)
            yield pairs(np.concatenate([v, u[at]]), np.concatenate([u, v[at]]), np.concatenate([new, new[at]]), np.repeat([False, True], [len(v), len(at)]))

    def fold(rows):
        v, u, new, back = rows
        there, here = np.flatnonzero(back), np.flatnonzero(~back)
        at = np.concatenate([here, there[_chosen(v[there], u[there], new[there], each, salt + 1)]])
        at = at[np.lexsort((u[at], v[at]))]
        return v[at], u[at], new[at], back[at]

    def rows(now):
        v, u, new, _ = now
        order = np.lexsort((~new, u, v))
        v, u, new = v[order], u[order], new[order]
        if len(v):
            once = np.append(True, (v[1:] != v[:-1]) | (u[1:] != u[:-1]))
            v, u, new = v[once], u[once], new[once]
            at = _starts(v)
            some = np.repeat(np.add.reduceat(new.astype(np.int64), at[:-1]) > 0, np.diff(at))
            v, u, new = v[some], u[some], new[some]
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(u, pa.int64()), pa.array(new, pa.bool_())], names=["v", "u", "new"])

    def flat(batch):
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[2:])

    both = graph.select(*_LIST.names).mapInArrow(run, "v long, u long, new boolean, back boolean")
    return _folded(both, "v", "v long, u long, new boolean", flat, fold, rows)


def _descend(graph: DataFrame, nodes: DataFrame, p: AnnParams, salt: int) -> DataFrame:
    """One NN-descent round: lists improved by the neighbours of neighbours."""

    def worst(batches):
        for batch in batches:
            sims, counts = _values(batch.column(1), np.float64)
            last = np.cumsum(counts) - 1
            thr = np.where(counts >= p.neighbours, sims[np.minimum(last, len(sims) - 1)] if len(sims) else 0.0, -2.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(thr, pa.float64())], names=["u", "thr"])

    known = nodes.select(F.col("id").alias("u"), "vec").join(graph.select("id", "sim").mapInArrow(worst, "u long, thr double"), "u")
    members = _both_ways(graph, p.sampled, salt).join(known, "u").select("v", "u", "new", "thr", "vec")

    def run(batches):
        for batch in _whole_groups(batches):
            at, ids = _starts(batch.column(0).to_numpy()), batch.column(1).to_numpy()
            new, thr, x = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), _vectors(batch.column(4))
            for a in range(0, len(at) - 1, 128):  # groups at once, padded to the largest
                ends = at[a : a + 129]
                sizes, rows = np.diff(ends), slice(ends[0], ends[-1])
                g, r, m = np.repeat(np.arange(len(sizes)), sizes), np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes), sizes.max()
                pad = np.zeros((len(sizes), m, x.shape[1]))
                pad[g, r] = x[rows]
                who, fresh, least = np.full((len(sizes), m), -1), np.zeros((len(sizes), m), bool), np.full((len(sizes), m), np.inf)
                who[g, r], fresh[g, r], least[g, r] = ids[rows], new[rows], thr[rows]
                there = np.zeros((len(sizes), m), bool)
                there[g, r] = True
                s = pad @ pad.transpose(0, 2, 1)
                ok = (s > least[:, :, None]) & there[:, None, :] & (fresh[:, :, None] | fresh[:, None, :])
                ok[:, np.arange(m), np.arange(m)] = False
                i, j, k = np.nonzero(ok)
                yield _to_lists(_best((who[i, j], who[i, k], s[i, j, k], np.full(len(i), FOUND, np.uint8)), p.neighbours))

    found = members.repartition("v").sortWithinPartitions("v").mapInArrow(run, _LIST)

    def aged(batches):  # those that were brought together now are old from here on
        for batch in batches:
            ids, nb, sim, mark = _to_flat(batch)
            mark = np.minimum(mark, NEW)
            mark[_chosen(ids, nb, mark > 0, p.sampled, salt)] = OLD
            yield _to_lists((ids, nb, sim, mark))

    return _merge_lists(graph.select(*_LIST.names).mapInArrow(aged, _LIST).unionByName(found), p.neighbours)


def list_recall(graph: DataFrame, nodes: DataFrame, p: AnnParams) -> float:
    """Share of the ``top`` true nearest of ``checked`` nodes, found among all nodes of their range, that their lists hold."""
    some = nodes.select("id", "part", "vec").orderBy(F.xxhash64("id", F.lit(11)), "id").limit(p.checked).collect()
    ids, parts = np.array([r.id for r in some], np.int64), np.array([r.part for r in some])
    held = nodes.sparkSession.sparkContext.broadcast((ids, parts, np.stack([np.frombuffer(r.vec, np.float32) for r in some]).astype(float)))

    def run(batches):
        ids, parts, c = held.value
        best = np.full((len(ids), p.top), -np.inf)
        for batch in batches:
            if batch.num_rows:
                s = c @ _vectors(batch.column(2)).T
                s[(parts[:, None] != batch.column(1).to_numpy()[None, :]) | (ids[:, None] == batch.column(0).to_numpy()[None, :])] = -np.inf
                best = -np.partition(-np.hstack([best, s]), p.top - 1, axis=1)[:, : p.top]
        k, j = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(ids[k]), pa.array(best[k, j])], names=["id", "sim"])

    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim")))
    true = nodes.select("id", "part", "vec").mapInArrow(run, "id long, sim double").withColumn("k", rank).where(F.col("k") <= p.top)
    least = {r.id: (r.least, r.n) for r in true.groupBy("id").agg(F.min("sim").alias("least"), F.count("*").alias("n")).collect()}
    lists = {r.id: np.frombuffer(r.sim) for r in graph.where(F.col("id").isin(ids.tolist())).select("id", "sim").collect()}
    return float(np.mean([(lists.get(i, np.empty(0))[:n] >= t - 1e-9).sum() / n for i, (t, n) in least.items()])) if least else 1.0


def build_graph(nodes: DataFrame, tmp: Scratch, p: AnnParams) -> DataFrame:
    """(id, nb, sim, mark, changed): the neighbour list of each node of nodes (part, id, vec) that has any, best first."""
    graph, k = None, 0

    def kept(lists: DataFrame) -> DataFrame:
        nonlocal k
        k += 1
        made = tmp.write(lists, f"graph-{k}", "lz4")
        tmp.drop(f"graph-{k - 1}")
        return made

    for turn in range(p.most_turns):
        leaves = Scratch(tmp.spark, "ann-leaves")
        lists = _leaf_lists(nodes, leaves, p, turn)
        graph = kept(_merge_lists(lists if graph is None else lists.unionByName(graph.select(*_LIST.names)), p.neighbours))
        leaves.drop("")
        while True:  # sums of similarities only grow, so this ends
            graph = kept(_descend(graph, nodes, p, 2 * k))
            changed, entries = graph.select(F.sum("changed"), F.sum(F.length("mark"))).first()
            if (changed or 0) <= p.settled * (entries or 0):
                break
        if list_recall(graph, nodes, p) >= p.aim:
            break
    return graph


# --- search ------------------------------------------------------------------------------------


def _rows(batch: pa.RecordBatch, columns: list[int], kinds: list) -> Iterator[tuple]:
    """Row by row the arrays of binary columns."""
    parts = []
    for c, kind in zip(columns, kinds, strict=True):
        values, counts = _values(batch.column(c), kind)
        parts.append(np.split(values, np.cumsum(counts)[:-1]) if len(counts) else [])
    return zip(*parts, strict=True)


def _begin(queries: DataFrame, nodes: DataFrame, tmp: Scratch, p: AnnParams) -> DataFrame:
    """State of each query and range of norms; q is the query's node."""
    order = Window.partitionBy("part").orderBy(F.xxhash64("id", F.lit(7)), "id")
    sample: dict = {}
    for r in nodes.select("part", "id", "raw").withColumn("k", F.row_number().over(order)).where(F.col("k") <= p.entries).orderBy("part", "id").collect():  # of each power of two at most
        sample.setdefault(r.part, ([], []))[0].append(r.id)
        sample[r.part][1].append(np.frombuffer(r.raw, np.float32))
    held = nodes.sparkSession.sparkContext.broadcast([(k, np.array(i, np.int64), np.stack(v).astype(float).T) for k, (i, v) in sample.items()])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q, part, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _vectors(batch.column(2))
            norm, raw, out = (x * x).sum(axis=1), batch.column(2).to_pylist(), []
            for own, ids, c in held.value:
                s = x @ c
                for r in range(len(q)):
                    best = np.argsort(-s[r])[: p.starts]
                    i, t = ids[best], s[r][best]
                    if part[r] == own:
                        i, t = np.append(i[i != q[r]], q[r]), np.append(t[i != q[r]], norm[r])
                    o = np.lexsort((i, -t))
                    out.append((int(q[r]), raw[r], i[o].tobytes(), t[o].tobytes(), bytes(len(o)), np.sort(i).tobytes()))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "q" else pa.binary()) for n, c in zip(["q", *_STATE.names[1:]], cols, strict=True)], names=["q", *_STATE.names[1:]])

    schema = StructType([StructField("q", LongType()), *_STATE.fields[1:]])
    return tmp.write(queries.select("q", "part", "raw").mapInArrow(run, schema).select(F.monotonically_increasing_id().alias("k"), "*"), "begun", "lz4")


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, tmp: Scratch, p: AnnParams) -> DataFrame:
    """(q, id, seen): the nodes that may be among the best that each query (q, part, raw; q a node) found, itself included; seen: how many it was compared with."""
    begun = _begin(queries, nodes, tmp, p)
    state, ended, turn = begun.drop("q").withColumn("on", F.lit(True)), [], 0
    vectors = nodes.select("id", "raw")

    def listed(batches):  # a node's list may be in several rows
        for batch in batches:
            at = _starts(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[:-1])), _packed(batch.column(1).to_numpy(), np.diff(at))], names=["id", "nb"])

    # Reverse neighbours lead to nodes that no list holds.
    lists = tmp.write(_both_ways(graph, p.neighbours, 0, aged=False).select("v", "u").mapInArrow(listed, "id long, nb binary"), "lists", "lz4")

    def frontier(batches):
        for batch in batches:
            ks, ids = [], []
            for k, (i, done) in zip(batch.column(0).to_pylist(), _rows(batch, [1, 2], [np.int64, np.uint8]), strict=True):
                ids.append(i[: p.expand][done[: p.expand] == 0])
                ks.append(np.full(len(ids[-1]), k))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (ks, ids)], names=["k", "id"])

    met_schema = StructType([*_STATE.fields, StructField("fresh", BinaryType())])

    def unseen(batches):
        """The state row of a group and the lists it met: what is expanded is marked, what was not seen yet is fresh."""
        for batch in _whole_groups(batches):
            out, at = [], _starts(batch.column(0).to_numpy())
            lists_, lengths = _values(batch.column(6).fill_null(b""), np.int64)
            ends = np.append(0, np.cumsum(lengths))
            own = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))  # one a group
            states = batch.take(pa.array(own)).columns
            for n, (a, b, (done, seen)) in enumerate(zip(at[:-1], at[1:], _rows(pa.RecordBatch.from_arrays(states, names=batch.schema.names), [4, 5], [np.uint8, np.int64]), strict=True)):
                done = done.copy()
                done[: p.expand] = 1
                fresh = np.setdiff1d(lists_[ends[a] : ends[b]], seen)
                out.append((states[0][n].as_py(), *(states[c][n].as_py() for c in (1, 2, 3)), done.tobytes(), np.union1d(seen, fresh).tobytes(), fresh.tobytes()))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "k" else pa.binary()) for n, c in zip(met_schema.names, cols, strict=True)], names=met_schema.names)

    def pairs(batches):
        for batch in batches:
            fresh, counts = _values(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), counts)), pa.array(fresh)], names=["k", "id"])

    def scored(batches):
        """The state row of a group and the vectors of its fresh nodes: the beam with these."""
        for batch in _whole_groups(batches):
            out, at, x = [], _starts(batch.column(0).to_numpy()), _vectors(batch.column(2))
            fresh, plain = batch.column(1).fill_null(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            own = np.flatnonzero(~plain)
            states = batch.take(pa.array(own)).columns
            flat = _rows(pa.RecordBatch.from_arrays(states, names=batch.schema.names), [3, 4, 5], [np.int64, np.float64, np.uint8])
            for n, (a, b, (ids, scores, done)) in enumerate(zip(at[:-1], at[1:], flat, strict=True)):
                rows = np.flatnonzero(plain[a:b]) + a
                s = x[rows] @ x[own[n]]
                ids, scores, done = np.concatenate([ids, fresh[rows]]), np.concatenate([scores, s]), np.concatenate([done, np.zeros(len(s), np.uint8)])
                o = np.lexsort((ids, -scores))[: p.beam]
                on = bool((done[o][: p.expand] == 0).any())
                out.append((states[0][n].as_py(), states[2][n].as_py(), ids[o].tobytes(), scores[o].tobytes(), done[o].tobytes(), states[6][n].as_py(), on))
            cols = zip(*out, strict=True)
            kinds = [pa.int64(), *[pa.binary()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[*_STATE.names, "on"])

    while turn == 0 or state.where("on").limit(1).count():  # each turn expands another node of every query that goes on
        live = state.where("on").select(*_STATE.names)
        met = live.select("k", "ids", "done").mapInArrow(frontier, "k long, id long").join(lists, "id").select("k", "nb")
        both = live.withColumn("nb", F.lit(None).cast("binary")).unionByName(met, allowMissingColumns=True)
        after = tmp.write(both.repartition("k").sortWithinPartitions("k").mapInArrow(unseen, met_schema), f"met-{turn}", "lz4")
        near = after.select("k", "fresh").mapInArrow(pairs, "k long, id long").join(vectors, "id").select("k", "id", "raw")
        rows = after.select("k", F.lit(None).cast("long").alias("id"), "raw", "ids", "scores", "done", "seen").unionByName(near, allowMissingColumns=True)
        ended.append(state.where("NOT on").select("k", "ids", "scores", "seen"))
        state = tmp.write(rows.repartition("k").sortWithinPartitions("k").mapInArrow(scored, StructType([*_STATE.fields, StructField("on", BooleanType())])), f"state-{turn}", "lz4")
        tmp.drop(f"met-{turn}")
        turn += 1
    ended.append(state.select("k", "ids", "scores", "seen"))

    def result(batches):
        for batch in batches:
            found, seen = [], []
            for ids, s, known in _rows(batch, [1, 2, 3], [np.int64, np.float64, np.int64]):
                found.append(ids[s >= s[min(p.top + 1, len(s) - 1)] - p.rounding])
                seen.append(len(known))
            n = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.concatenate(found) if found else [], pa.int64()), pa.array(np.repeat(seen, n), pa.int64())], names=["k", "id", "seen"])

    every = reduce(DataFrame.unionByName, ended).mapInArrow(result, "k long, id long, seen long")
    found = tmp.write(every.join(begun.select("k", "q"), "k").select("q", "id", "seen"), "found")
    tmp.drop("begun", "lists", *[f"state-{k}" for k in range(turn)])
    return found


# --- the whole ---------------------------------------------------------------------------------


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(finite & F.exists("v", lambda x: x != 0))


def node_table(reps: DataFrame, tmp: Scratch, dim: int) -> DataFrame:
    """(id, part, vec, raw) of reps (id, v), all of one length: vec for the graph, raw for products with queries."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    ranged = reps.withColumn("part", F.greatest(F.lit(LEAST_PART), F.floor(F.log2(norm) + 0.5).cast("int")))
    most = ranged.agg(F.max("part")).first()[0]

    def scaled(batches):
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, dim)
            x = np.ldexp(v, -1 - batch.column(2).to_numpy()[:, None])  # norms below 0.71
            last = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
            full = np.hstack([x, last[:, None]]).astype(np.float32)
            raw = np.ldexp(v, -1 - most).astype(np.float32)  # by a power of two: vectors of single precision stay as they are
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _packed(full.ravel(), np.full(len(v), dim + 1)), _packed(raw.ravel(), np.full(len(v), dim))], names=["id", "part", "vec", "raw"])

    return tmp.write(ranged.select("id", "v", "part").mapInArrow(scaled, "id long, part int, vec binary, raw binary"), f"nodes-{dim}", "lz4")


def nearest(vectors: DataFrame, every: int, p: AnnParams = AnnParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row whose id is divisible by every."""
    spark = vectors.sparkSession
    tmp = Scratch(spark, "ann")
    rows = clean(vectors, id_col, vector_col).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))
    # Of a node's copies an answer needs the smallest ids only: as many as it is long, and one for the query itself.
    by_class = Window.partitionBy("h1", "h2").orderBy("vec_id")
    small = rows.select("h1", "h2", "vec_id").withColumn("c", F.dense_rank().over(by_class)).where(F.col("c") <= p.top + 1).distinct()
    small = tmp.write(small, "small")
    # A node is known by its first hash; different vectors that share it are told apart by rank.
    classes = small.where("c = 1").withColumn("id", F.col("h1") + F.row_number().over(Window.partitionBy("h1").orderBy("h2")) - 1).select("h1", "h2", "id", F.col("vec_id").alias("first"))
    classes = tmp.write(classes, "classes")
    small = small.join(classes.select("h1", "h2", "id"), ["h1", "h2"]).select("id", "vec_id")
    reps = rows.join(classes, ["h1", "h2"]).where("vec_id = first").select("id", "v", F.size("v").alias("d")).dropDuplicates(["id"])
    reps = tmp.write(reps, "reps", "lz4")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select("h1", "h2", "vec_id").distinct()
    asked = tmp.write(asked.join(classes.select("h1", "h2", "id"), ["h1", "h2"]).select("id", "vec_id"), "asked")
    found = []
    for dim in [r.d for r in reps.groupBy("d").count().orderBy("d").collect()]:
        own = Scratch(spark, f"ann-{dim}")
        nodes = node_table(reps.where(F.col("d") == dim), own, dim)
        queries = own.write(nodes.join(asked.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("q"), "part", "raw"), "queries", "lz4")
        if queries.limit(1).count():
            found.append(search(queries, build_graph(nodes, own, p), nodes, own, p).select("q", "id").distinct())
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pairs = reduce(DataFrame.unionByName, found)

    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    scored = pairs.join(reps.select(F.col("id").alias("q"), F.col("v").alias("a")), "q").join(reps.select("id", F.col("v").alias("b")), "id").select("q", "id", product.alias("score"))
    by_node = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    answers = scored.join(small, "id").groupBy("q", "vec_id").agg(F.max("score").alias("score")).withColumn("k", F.row_number().over(by_node)).where(F.col("k") <= p.top + 1).select("q", "vec_id", "score")
    each = asked.select(F.col("id").alias("q"), F.col("vec_id").alias("query_id")).join(answers, "q").where("query_id <> vec_id")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= p.top).select("query_id", F.col("rank").cast("int"), "vec_id", "score")

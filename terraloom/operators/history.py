"""Version histories: for each entity the row in the update window and the row before it.

rows: the working set of ``augment`` (entity columns, origin, origin_rank). Nodes first, then
ways over node histories, then relations over both; predicates hold for each *version* with
that version's own parts, while member relations are looked up by their latest row. The
before-row of an entity is dropped if it is invisible; it isn't replaced by an older one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NODE, RELATION, UPDATE, WAY
from ..scratch import WorkTables
from .closure import reachable

ROW = ["id", "type", "version", "timestamp", "origin_rank"]
#: So many nodes meet the vertices by a broadcast (24 bytes each), which spares a shuffle and a sort of all vertices.
MOST_SENT = 1 << 21
#: What no flag of a row depends on, and what only those of the row itself do.
BARE = ("tags", "lat", "lon", "changeset", "uid", "user")
PARTS = ("nds", "members")


def newest() -> Column:
    """Versions by time, then origin, then version number."""
    return F.struct(F.col("timestamp"), -F.col("origin_rank"), F.col("version"))


def changed() -> Column:
    return F.col("origin") == UPDATE


def latest(rows: DataFrame) -> DataFrame:
    """The newest row of each (type, id)."""
    data = F.struct(*rows.columns)
    return rows.groupBy("id", "type").agg(F.max_by(data, newest()).alias("r")).select("r.*")


def histories(flagged: DataFrame) -> DataFrame:
    """(id, type, now, before) from rows with ``complete``, ``window`` and ``prior`` flags: two nullable structs of the row."""
    data = F.struct(*[c for c in flagged.columns if c not in ("complete", "window", "prior")])
    pick = lambda flag: F.max_by(data, F.when(F.col("complete") & F.col(flag), newest()))
    h = flagged.groupBy("id", "type").agg(pick("window").alias("now"), pick("prior").alias("before"), F.max(F.col("complete") & F.col("window")).alias("w"), F.max(F.col("complete") & F.col("prior")).alias("b"))
    return h.select("id", "type", F.when(F.col("w"), F.col("now")).alias("now"), F.when(F.col("b") & F.col("before.visible"), F.col("before")).alias("before"))


def node_histories(rows: DataFrame) -> DataFrame:
    n = rows.where(F.col("type") == NODE)
    return histories(n.withColumns({"complete": F.lit(True), "window": changed(), "prior": ~changed()}))


def way_uses(rows: DataFrame) -> DataFrame:
    """(id, type, version, timestamp, origin_rank, ref): the vertices of each version of a way, each once."""
    return rows.where(F.col("type") == WAY).select(*ROW, F.explode(F.array_distinct("nds.ref")).alias("ref"))


def way_flags(rows: DataFrame, nodes: DataFrame, uses: DataFrame | None = None) -> DataFrame:
    """Ways with their flags: complete if all vertices are known (and none is deleted in the
    window of a visible way), in the window if changed or any vertex is, prior if unchanged
    and every vertex has a row before.

    uses: the vertices like those of ``way_uses``, for rows without ``nds``; repeats are fine.
    """
    w = rows.where(F.col("type") == WAY)
    v = way_uses(rows) if uses is None else uses
    # The states of a node as bits: in the window 1, before it 2, deleted in the window 4, either of the first two 8.
    n, o = F.col("now").isNotNull(), F.col("before").isNotNull()
    known = nodes.select(F.col("id").alias("ref"), reduce(Column.bitwiseOR, [F.when(is_, b).otherwise(0) for is_, b in ((n, 1), (o, 2), (~F.col("now.visible"), 4), (n | o, 8))]).alias("s"))
    if nodes.limit(MOST_SENT + 1).count() <= MOST_SENT:
        known = F.broadcast(known)
    s = F.coalesce("s", F.lit(0))
    flags = v.join(known, "ref", "left").groupBy(*ROW).agg(F.bit_and(s).alias("every"), F.bit_or(s).alias("some"))
    has = lambda c, b: F.col(c).bitwiseAND(b) != 0
    flags = flags.select(*ROW, has("every", 8).alias("all_known"), has("some", 1).alias("any_new"), has("every", 2).alias("all_old"), has("some", 4).alias("any_gone"))
    f = w.join(flags, ROW, "left")
    window = changed() | F.coalesce("any_new", F.lit(False))
    prior = ~changed() & F.coalesce("all_old", F.lit(True))
    drawable = ~F.coalesce("any_gone", F.lit(False))
    return f.withColumns({"complete": F.coalesce("all_known", F.lit(True)), "window": window & (drawable | ~F.col("visible")), "prior": prior}).drop("all_known", "any_new", "all_old", "any_gone")


def way_histories(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    return histories(way_flags(rows, nodes))


def relation_flags(rows: DataFrame, nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """Relations with their flags; through member relations (their latest rows) "window" spreads by
    any, "prior" by all, both as least fixpoints over relation-to-relation edges, so cycles end."""
    rel = rows.where(F.col("type") == RELATION)
    # Repeated members change none of the flags; arrays of structs are made distinct by comparing all pairs, so they stay.
    member = rel.select(*ROW, F.explode("members").alias("m")).select(*ROW, F.col("m.type").alias("mt"), F.col("m.ref").alias("ref"))
    drawn = nodes.unionByName(ways).select(F.col("type").alias("mt"), F.col("id").alias("ref"), F.col("now").isNotNull().alias("n"), F.col("before").isNotNull().alias("o"))
    some = rel.select(F.lit(RELATION).alias("mt"), F.col("id").alias("ref")).distinct().withColumns({"n": F.lit(None).cast("boolean"), "o": F.lit(None).cast("boolean")})
    known = drawn.where("n OR o").unionByName(some).withColumn("there", F.lit(True))
    own = member.join(known, ["ref", "mt"], "left")
    inner = F.col("mt") != RELATION
    own = own.groupBy(*ROW).agg(
        F.bool_and(F.coalesce("there", F.lit(False))).alias("complete"), F.bool_or(inner & F.coalesce("n", F.lit(False))).alias("own_new"),
        F.bool_and(~inner | F.coalesce("o", F.lit(False))).alias("own_old"),
    )
    f = rel.join(own, ROW, "left").withColumns({
        "complete": F.coalesce("complete", F.lit(True)), "own_new": changed() | F.coalesce("own_new", F.lit(False)),
        "own_old": ~changed() & F.coalesce("own_old", F.lit(True)),
    })
    tmp = WorkTables(rows.sparkSession, "relations")
    f = tmp.keep(f, "own")
    # Beyond the flags of their own only member relations count, so nothing else is sorted or searched.
    nested = f.select(*ROW, "own_new", "own_old", F.filter("members", lambda m: m["type"] == RELATION)["ref"].alias("refs"))
    last = tmp.keep(latest(nested), "last")
    # A step leads from a member relation to the latest row of what holds it.
    inside = lambda df: df.select(*ROW, F.explode("refs").alias("ref"))
    steps = inside(last).select(F.col("ref").alias("src"), F.col("id").alias("dst"))
    seed = lambda which, k: last.where(which).select(F.col("id").alias("v"), F.lit(k).alias("k"))
    reached = reachable(seed("own_new", "moved").unionByName(seed("NOT own_old", "blocked")), steps)
    via = inside(nested).join(reached.withColumnRenamed("v", "ref"), "ref").groupBy(*ROW).agg(F.bool_or(F.col("k") == "moved").alias("mv"), F.bool_or(F.col("k") == "blocked").alias("bl"))
    f = f.join(via, ROW, "left")
    return f.withColumns({"window": F.col("own_new") | F.coalesce("mv", F.lit(False)), "prior": F.col("own_old") & ~F.coalesce("bl", F.lit(False))}).drop("own_new", "own_old", "mv", "bl")


def relation_histories(rows: DataFrame, nodes: DataFrame, ways: DataFrame) -> DataFrame:
    return histories(relation_flags(rows, nodes, ways))


@dataclass(frozen=True)
class Histories:
    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame

    def all(self) -> DataFrame:
        """Keyed by (type, id), so that entities of different types with one id stay apart."""
        return self.nodes.unionByName(self.ways).unionByName(self.relations)

    def by_id_alone(self) -> DataFrame:
        """For compatibility with outputs keyed by id: of a relation, way and node with one id the first of these stays."""
        rank = F.when(F.col("type") == RELATION, 0).when(F.col("type") == WAY, 1).otherwise(2)
        every = self.all()
        return every.groupBy("id").agg(F.min_by(F.struct(*every.columns), rank).alias("h")).select("h.*")


def all_histories(rows: DataFrame, contents: bool = True, uses: DataFrame | None = None) -> Histories:
    """Histories of all three types; each level is written once, as the next ones read it repeatedly.

    Without ``contents`` their rows lack tags, places, authors and parts, which then are not shuffled.
    uses: see ``way_flags``.
    """
    tmp = WorkTables(rows.sparkSession, "histories")
    left = () if contents else PARTS
    rows = tmp.keep(rows if contents else rows.drop(*BARE), "rows")
    nodes = tmp.keep(node_histories(rows.drop(*left)), "nodes")
    ways = tmp.keep(histories(way_flags(rows, nodes, uses).drop(*left)), "ways")
    return Histories(nodes, ways, tmp.keep(histories(relation_flags(rows, nodes, ways).drop(*left)), "relations"))


def features(h: DataFrame) -> DataFrame:
    """(id, type, mode, visible, row): what is drawn of each history.

    Both states, visible now: the new and the old one. Both, deleted now: the old one.
    Only the new state: that, if visible. Otherwise nothing. Old states are shown invisible.
    """
    now, before = F.col("now").isNotNull(), F.col("before").isNotNull()
    new = F.when(now & F.col("now.visible"), F.struct(F.lit("in").alias("mode"), F.lit(True).alias("visible"), F.col("now").alias("row")))
    old = F.when(now & before, F.struct(F.lit("before").alias("mode"), F.lit(False).alias("visible"), F.col("before").alias("row")))
    return h.select("id", "type", F.explode(F.filter(F.array(new, old), lambda x: x.isNotNull())).alias("f")).select("id", "type", "f.mode", "f.visible", "f.row")

"""Geometry of the features that histories call for, and their GeoJSON lines.

A state of a way is drawn with its vertices as of the same state ("in": the vertex in the
window if there is one, else the one before; "before": the one before). Relations are drawn
after their members, level by level of nesting, so a relation of relations finds its parts
drawn, however deep it is nested. Relations on a cycle, or above one, have no deepest level:
when only these are left they are drawn for ``CYCLE_DEPTH`` more levels, with a warning.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from ..functions.tags import is_area, is_multipolygon
from ..geometry import assembly, wkb
from ..schema import NODE, RELATION, WAY
from ..scratch import WorkTables
from .history import Histories, features

#: Levels in which relations on or above a cycle are drawn; they lack the parts beyond.
CYCLE_DEPTH = 6
#: States of an entity: in the window, and before it.
MODES = ("in", "before")


def vertex_states(nodes: DataFrame) -> DataFrame:
    """(ref, mode, lon, lat): where each node is in either mode."""
    now, before = F.col("now"), F.col("before")
    alive = now.isNotNull() & now["visible"]
    in_ = F.when(alive, F.struct(F.lit("in").alias("mode"), now["lon"].alias("lon"), now["lat"].alias("lat"))).when(now.isNull() & before.isNotNull(), F.struct(F.lit("in").alias("mode"), before["lon"].alias("lon"), before["lat"].alias("lat")))
    old = F.when(before.isNotNull(), F.struct(F.lit("before").alias("mode"), before["lon"].alias("lon"), before["lat"].alias("lat")))
    return nodes.select(F.col("id").alias("ref"), F.explode(F.filter(F.array(in_, old), lambda s: s.isNotNull())).alias("s")).select("ref", "s.*")


def _listed(ways: DataFrame, nodes: DataFrame, **at: Column) -> DataFrame:
    """(id, mode, p): of each way state's vertices in order the position and ``at``, made of lon and lat; ways (id, mode, row)."""
    v = ways.select("id", "mode", F.posexplode("row.nds").alias("pos", "nd")).select("id", "mode", "pos", F.col("nd.ref").alias("ref"))
    v = v.join(vertex_states(nodes).select("ref", "mode", *[c.alias(name) for name, c in at.items()]), ["ref", "mode"])
    return v.groupBy("id", "mode").agg(F.array_sort(F.collect_list(F.struct("pos", *at))).alias("p"))


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, mode, points): each way state's vertices in order; ways (id, mode, row)."""
    listed = _listed(ways, nodes, x=F.col("lon").cast("double"), y=F.col("lat").cast("double"))
    return listed.select("id", "mode", F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("points"))


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(…, line, polygon): ways (id, mode, row, …) with their vertices as JSON, each node's written once, and whether they are drawn as polygons."""
    p = F.col("p")
    listed = _listed(ways, nodes, at=_pair(F.col("lon"), F.col("lat")))
    listed = listed.select("id", "mode", F.concat(F.lit("["), F.array_join(p["at"], ","), F.lit("]")).alias("line"), F.element_at(p, 1)["at"].eqNullSafe(F.element_at(p, -1)["at"]).alias("closed"))
    drawn = ways.join(listed, ["id", "mode"], "left")
    return drawn.withColumns({"line": F.coalesce("line", F.lit("[]")), "polygon": F.coalesce(is_area(F.col("row.tags")) & F.col("closed"), F.lit(False))}).drop("closed")


def ring_area(points: Column, tags: Column) -> Column:
    """Whether a way is drawn as a polygon: an area by its tags, and closed."""
    return is_area(tags) & (F.size(points) > 0) & (F.element_at(points, 1) == F.element_at(points, -1))


@F.pandas_udf(BinaryType())
def _flat_wkb(xy: pd.Series, polygon: pd.Series) -> pd.Series:
    def one(p, poly):
        at = np.empty((0, 2)) if p is None else np.asarray(p, float).reshape(-1, 2)
        return wkb.dump(wkb.POLYGON, [at]) if poly else wkb.dump(wkb.LINE, at)

    return pd.Series([one(p, poly) for p, poly in zip(xy, polygon, strict=True)], dtype=object)


def _way_wkb(points: Column, polygon: Column) -> Column:
    """WKB of lines or polygons through points (x, y), which pass to Python as plain numbers."""
    return _flat_wkb(F.flatten(F.transform(points, lambda q: F.array(q["x"], q["y"]))), polygon)


@F.pandas_udf(BinaryType())
def _point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pd.Series([wkb.dump(wkb.POINT, (x, y)) for x, y in zip(lon, lat, strict=True)], dtype=object)


CODES = {NODE: 1, WAY: 2, RELATION: 3}


@F.pandas_udf(BinaryType())
def _relation_wkb(members: pd.Series, polygon: pd.Series) -> pd.Series:
    """Polygons where asked for and possible; else lines as one multi-line if there are only lines; else a collection."""

    def one(parts, poly):
        parts = [] if parts is None else [m for m in parts if m["wkb"] is not None]
        shapes = [bytes(m["wkb"]) for m in parts]
        if poly:
            made = assembly.multipolygon([CODES[m["type"]] for m in parts], [m["role"] for m in parts], shapes)
            if made is not None:
                return made
        loaded = [wkb.load(s) for s in shapes]
        if loaded and not poly and all(kind in (wkb.LINE, wkb.MULTILINE) for kind, _ in loaded):
            return wkb.dump(wkb.MULTILINE, [x for g in loaded for x in wkb.lines_of(*g)])
        return wkb.dump(wkb.COLLECTION, loaded)

    return pd.Series([one(p, poly) for p, poly in zip(members, polygon, strict=True)], dtype=object)


def _members(parts) -> tuple[list, list, list]:
    parts = [] if parts is None else list(parts)
    return [CODES[m["type"]] for m in parts], [m["role"] for m in parts], [None if m["wkb"] is None else bytes(m["wkb"]) for m in parts]


@F.pandas_udf(BinaryType())
def multipolygon_wkb(members: pd.Series) -> pd.Series:
    """WKB of the polygons of members (array of type, role, wkb); null if a way has no geometry or rings can't be assembled."""
    return pd.Series([assembly.multipolygon(*_members(p)) for p in members], dtype=object)


@F.pandas_udf(ArrayType(StructType([StructField("role", StringType()), StructField("wkb", BinaryType())])))
def route_wkb(members: pd.Series) -> pd.Series:
    """The joined lines of members (array of type, role, wkb) by role; null if a way has no geometry."""
    made = (assembly.route(*_members(p)) for p in members)
    return pd.Series([None if r is None else [{"role": role, "wkb": g} for role, g in r] for r in made], dtype=object)


def states(h: DataFrame, *more: str) -> DataFrame:
    """(id, type, mode, row): every state that a container may draw; in mode "in" the old row stands in for a missing new one.

    more: columns that are handed on.
    """
    now, before = F.col("now"), F.col("before")
    in_ = F.when(now.isNotNull() & now["visible"], F.struct(F.lit("in").alias("mode"), now.alias("row"))).when(now.isNull() & before.isNotNull(), F.struct(F.lit("in").alias("mode"), before.alias("row")))
    old = F.when(before.isNotNull(), F.struct(F.lit("before").alias("mode"), before.alias("row")))
    return h.select("id", "type", *more, F.explode(F.filter(F.array(in_, old), lambda s: s.isNotNull())).alias("s")).select("id", "type", *more, "s.*")


def geometries(h: Histories, modes: tuple[str, ...] = MODES, parts_only: bool = False) -> DataFrame:
    """(type, id, mode, wkb) of every state of every entity of the histories, in these modes.

    parts_only: of nodes and ways only those that are members of a relation drawn.
    """
    tmp = WorkTables(h.nodes.sparkSession, "geometries")
    shown = lambda df: states(df).where(F.col("mode").isin(*modes))
    rel = tmp.keep(shown(h.relations).select("id", "type", "mode", "row.members", "row.tags"), "relations")
    inner = rel.select("id", "mode", F.posexplode("members").alias("pos", "m")).select("id", "mode", "pos", F.col("m.type").alias("mt"), F.col("m.ref").alias("ref"), F.col("m.role").alias("role"))
    used = inner.where(F.col("mt") != RELATION).select(F.col("mt").alias("type"), F.col("ref").alias("id"), "mode").distinct()
    level_0 = lambda df: shown(df).join(used, ["type", "id", "mode"], "left_semi") if parts_only else shown(df)
    points = level_0(h.nodes).select("type", "id", "mode", _point_wkb(F.col("row.lon").cast("double"), F.col("row.lat").cast("double")).alias("wkb"))
    w = level_0(h.ways)
    w = w.join(way_points(w, h.nodes), ["id", "mode"], "left")
    lines = w.select("type", "id", "mode", _way_wkb(F.col("points"), F.coalesce(ring_area(F.col("points"), F.col("row.tags")), F.lit(False))).alias("wkb"))
    done = tmp.keep(points.unionByName(lines), "level-0")
    return _by_levels(tmp, rel, inner, done, ["wkb"], lambda some: some.select("type", "id", "mode", _relation_wkb("parts", is_multipolygon(F.col("tags"))).alias("wkb")))


def _by_levels(tmp: WorkTables, rel: DataFrame, inner: DataFrame, done: DataFrame, columns: list[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """done, and the relations rel (id, mode, …) with members inner (id, mode, pos, mt, ref, role), which make draws from their ``parts`` of these columns.

    A level draws the relations whose nested relations are all drawn; what then is left leads to a cycle.
    """
    known = rel.select(F.col("id").alias("ref"), "mode")
    nested = tmp.keep(inner.where(F.col("mt") == RELATION).select("id", "mode", "ref").distinct().join(known, ["ref", "mode"], "left_semi"), "nested")
    keys = ["id", "mode"]

    def draw(some: DataFrame, parts: DataFrame, name: str) -> DataFrame:
        at = inner.join(some.select(*keys), keys, "left_semi").join(parts.select(F.col("type").alias("mt"), F.col("id").alias("ref"), "mode", *columns), ["ref", "mode", "mt"])
        listed = at.groupBy("id", "mode").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("mt").alias("type"), "role", *columns))).alias("parts"))
        return tmp.keep(make(some.join(listed, keys, "left")), name)

    if not nested.limit(1).count():
        return done.unionByName(draw(rel, done, "relations-0"))
    left, level = rel, 0
    while True:
        waits = nested.join(left.select(F.col("id").alias("ref"), "mode"), ["ref", "mode"], "left_semi").select(*keys).distinct()
        ready = left.join(waits, keys, "left_anti")
        if not ready.limit(1).count():
            break
        ready = tmp.keep(ready, f"ready-{level}")
        done = done.unionByName(draw(ready, done, f"relations-{level}"))
        left = tmp.keep(left.join(ready.select(*keys), keys, "left_anti"), f"left-{level}")
        level += 1
    cyclic, drawn = left.select("id").distinct().count(), None
    if cyclic:
        warnings.warn(f"{cyclic} relations are on or above a cycle of relations and are drawn to {CYCLE_DEPTH} levels only", stacklevel=2)
    for k in range(CYCLE_DEPTH if cyclic else 0):
        before, drawn = drawn, draw(left, done if drawn is None else done.unionByName(drawn), f"cycle-{k}")
        if before is not None and drawn.exceptAll(before).limit(1).count() == 0:
            break
    return done if drawn is None else done.unionByName(drawn)


def iso_instant(ts: Column) -> Column:
    """ISO 8601 in UTC; fractions of a second only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    part = F.when(micros == 0, "").when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("int").cast("string"), 3, "0"))).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, part, F.lit("Z"))


def properties(row: Column, visible: Column) -> Column:
    return F.struct(
        row["id"].alias("id"), row["type"].alias("type"), F.coalesce(row["tags"], F.create_map().cast("map<string,string>")).alias("tags"), row["changeset"].alias("changeset"),
        iso_instant(row["timestamp"]).alias("timestamp"), row["uid"].alias("uid"), row["user"].alias("user"), row["version"].alias("version"), visible.alias("visible"),
    )


def _pair(x: Column, y: Column) -> Column:
    return F.concat(F.lit("["), x.cast("double").cast("string"), F.lit(","), y.cast("double").cast("string"), F.lit("]"))


def _point_shapes(nodes: DataFrame) -> DataFrame:
    """Features of nodes with their geometry as JSON, ``shape``: native."""
    shape = F.concat(F.lit('{"type":"Point","coordinates":'), _pair(F.col("row.lon"), F.col("row.lat")), F.lit("}"))
    return features(nodes).withColumn("shape", shape)


def _line_shapes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Features of ways with their geometry as JSON, ``shape``: native."""
    shape = F.when(F.col("polygon"), _polygon_json(F.col("line"))).otherwise(_json_of(F.lit(_LINE), F.col("line")))
    return way_lines(features(ways), nodes).withColumn("shape", shape).select("id", "type", "mode", "visible", "row", "shape")


#: How the JSON of a geometry is held while relations are drawn: a line's and a multi-line's coordinates, the latter's without the outer brackets, or the whole geometry.
_LINE, _LINES, _WHOLE = "line", "lines", "whole"
_POLYGON = '{"type":"Polygon",'


def _json_of(kind: Column, text: Column) -> Column:
    line, lines = F.concat(F.lit('{"type":"LineString","coordinates":'), text, F.lit("}")), F.concat(F.lit('{"type":"MultiLineString","coordinates":['), text, F.lit("]}"))
    return F.when(kind == _LINE, line).when(kind == _LINES, lines).otherwise(text)


def _polygon_json(line: Column) -> Column:
    return F.concat(F.lit(_POLYGON + '"coordinates":['), line, F.lit("]}"))


def _wkb_of(kind: str, text: str | None) -> bytes | None:
    if text is None:
        return None
    at = lambda points: np.asarray(points, float).reshape(-1, 2)
    return wkb.dump(wkb.LINE, at(json.loads(text))) if kind == _LINE else wkb.dump(wkb.POLYGON, [at(r) for r in json.loads(text)["coordinates"]])


@F.pandas_udf(StringType())
def _assembled(members: pd.Series) -> pd.Series:
    """JSON of the polygons of members (array of type, role, kind, text; texts of lines and polygons); null if they can't be assembled, or are null."""

    def one(parts):
        made = None if parts is None else assembly.multipolygon([CODES[m["type"]] for m in parts], [m["role"] for m in parts], [_wkb_of(m["kind"], m["text"]) for m in parts])
        return None if made is None else json.dumps(wkb.to_geojson(*wkb.load(made)), separators=(",", ":"))

    return pd.Series([one(p) for p in members], dtype=object)


def _relation_json(some: DataFrame) -> DataFrame:
    """Relations drawn from the JSON of their parts, by the rules of ``_relation_wkb``: only polygons are made outside the JVM, of which lines and polygons are parts."""
    parts = F.coalesce("parts", F.array().cast(some.schema["parts"].dataType))
    ring = lambda m: F.when((m["kind"] == _LINE) | m["text"].startswith(_POLYGON), m["text"])
    made = _assembled(F.when(F.col("polygon"), F.transform(parts, lambda m: F.struct(m["type"].alias("type"), m["role"].alias("role"), m["kind"].alias("kind"), ring(m).alias("text")))))
    lines = ~F.col("polygon") & (F.size(parts) > 0) & F.forall(parts, lambda m: m["kind"].isin(_LINE, _LINES))
    nowhere = F.lit('{"type":"Point","coordinates":[]}')  # nodes without a place
    whole = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), F.array_join(F.transform(parts, lambda m: F.coalesce(_json_of(m["kind"], m["text"]), nowhere)), ","), F.lit("]}"))
    text = F.coalesce("made", F.when(lines, F.array_join(F.transform(parts, lambda m: m["text"]), ",")).otherwise(whole))
    return some.withColumn("made", made).select("type", "id", "mode", "shown", "props", F.when(lines, _LINES).otherwise(_WHOLE).alias("kind"), text.alias("text"))


def _with_relations(h: Histories) -> DataFrame:
    """(type, id, mode, shown, props, kind, text): ways and relations to be shown, and their parts, each drawn once."""
    tmp = WorkTables(h.nodes.sparkSession, "geojson")
    # Of an entity with a row in the window all states are shown.
    shown = F.col("shown")
    every = lambda df: states(df.withColumn("shown", F.col("now").isNotNull()), "shown")
    props = F.when(shown, _properties_json(F.col("row"), F.col("mode") == "in")).alias("props")
    rel = tmp.keep(every(h.relations).select("id", "type", "mode", "shown", props, "row.members", is_multipolygon(F.col("row.tags")).alias("polygon")), "relations")
    inner = rel.select("id", "mode", F.posexplode("members").alias("pos", "m")).select("id", "mode", "pos", F.col("m.type").alias("mt"), F.col("m.ref").alias("ref"), F.col("m.role").alias("role"))
    used = inner.where(F.col("mt") != RELATION).select(F.col("ref").alias("id"), "mode", F.col("mt").alias("type")).distinct()
    point = F.concat(F.lit('{"type":"Point","coordinates":'), _pair(F.col("row.lon"), F.col("row.lat")), F.lit("}"))
    points = every(h.nodes).join(used, ["id", "mode", "type"], "left_semi").select("type", "id", "mode", F.lit(False).alias("shown"), F.lit(None).cast("string").alias("props"), F.lit(_WHOLE).alias("kind"), point.alias("text"))
    w = every(h.ways).join(used.withColumn("used", F.lit(True)), ["id", "mode", "type"], "left").where(shown | F.col("used"))
    # Written, as it is read twice: for the vertices, and for the rest.
    w = tmp.keep(w.select("type", "id", "mode", "shown", props, F.struct("row.nds", "row.tags").alias("row")), "ways")
    area, at = F.col("polygon"), F.col("line")
    ways = way_lines(w, h.nodes).select("type", "id", "mode", "shown", "props", F.when(area, _WHOLE).otherwise(_LINE).alias("kind"), F.when(area, _polygon_json(at)).otherwise(at).alias("text"))
    done = tmp.keep(points.unionByName(ways), "level-0")
    return _by_levels(tmp, rel.drop("members"), inner, done, ["kind", "text"], _relation_json)


def _properties_json(row: Column, visible: Column) -> Column:
    return F.to_json(properties(row, visible), {"ignoreNullFields": "false"})


def geojson(h: Histories) -> DataFrame:
    """(type, id, mode, value): one GeoJSON feature for each state to be shown. Only relations' polygons are drawn outside the JVM."""
    shown = _point_shapes(h.nodes)
    with_relations = features(h.relations).limit(1).count() > 0
    if not with_relations:
        shown = shown.unionByName(_line_shapes(h.ways, h.nodes))
    line = lambda shape, props: F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(shape, F.lit("null")), F.lit(',"properties":'), props, F.lit("}")).alias("value")
    lines = shown.select("type", "id", "mode", line(F.col("shape"), _properties_json(F.col("row"), F.col("visible"))))
    if with_relations:
        lines = lines.unionByName(_with_relations(h).where("shown").select("type", "id", "mode", line(_json_of(F.col("kind"), F.col("text")), F.col("props"))))
    return lines


def unquoted(line: Column) -> Column:
    """For compatibility with outputs in which every text that looks like a whole number, true or false stands without quotes, in tags too."""
    return F.regexp_replace(F.regexp_replace(line, r'"(\d+)"', "$1"), '"(true|false)"', "$1")


def write_geojson(features_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Newline-delimited GeoJSON below path."""
    features_df.select("value").write.mode(mode).text(path)


def routes(members: DataFrame) -> DataFrame:
    """(id, role, wkb) of route relations' members (id, pos, type, role, wkb): a row for each role, lines joined where ends meet.

    Relations with a way that has no geometry give no rows.
    """

    def join(batches):
        for batch in batches:
            ids, roles, shapes = [], [], []
            for i, parts in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for role, g in assembly.route([CODES[m["type"]] for m in parts], [m["role"] for m in parts], [m["wkb"] for m in parts]) or []:
                    ids.append(i.as_py())
                    roles.append(role)
                    shapes.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(roles, pa.string()), pa.array(shapes, pa.binary())], names=["id", "role", "wkb"])

    listed = members.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "type", "role", "wkb"))).alias("parts"))
    schema = StructType([listed.schema["id"], StructField("role", StringType()), StructField("wkb", BinaryType())])
    return listed.select("id", "parts").mapInArrow(join, schema)

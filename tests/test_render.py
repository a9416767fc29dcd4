from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql.types import StructField, StructType, StringType, LongType

from terraloom.geometry import wkb
from terraloom.operators import render
from terraloom.operators.history import Histories
from terraloom.schema import ENTITY, NODE, RELATION, WAY


def row(i, kind, members=None, **more):
    return {f.name: None for f in ENTITY.fields} | {"id": i, "type": kind, "tags": {}, "visible": True, "members": members} | more


def drawn(spark, members):
    """GeoJSON of every relation (id -> member ids); id 0 is a node."""
    schema = StructType([StructField("id", LongType()), StructField("type", StringType()), StructField("now", ENTITY), StructField("before", ENTITY)])
    make = lambda rows: spark.createDataFrame([(r["id"], r["type"], tuple(r[f.name] for f in ENTITY.fields), None) for r in rows], schema)
    rel = [row(i, RELATION, [(NODE if m == 0 else RELATION, m, "") for m in parts]) for i, parts in members.items()]
    h = Histories(make([row(0, NODE, lon=Decimal(5), lat=Decimal(6))]), make([]), make(rel))
    got = render.geometries(h).where("type = 'relation' AND mode = 'in'").collect()
    assert len(got) == len(members)
    return {r.id: json.dumps(wkb.to_geojson(*wkb.load(bytes(r.wkb)))) for r in got}


def test_relations_are_drawn_however_deep_they_are_nested(spark):
    got = drawn(spark, {1: [0]} | {i: [i - 1] for i in range(2, 10)})
    assert all(g.count('"Point"') == 1 for g in got.values())


def test_cycles_end_with_a_warning_and_leave_other_relations_whole(spark):
    with pytest.warns(UserWarning, match="3 relations are on or above a cycle"):
        got = drawn(spark, {1: [0], 2: [1], 11: [12, 0], 12: [11], 13: [12, 2]})
    assert got[2].count('"Point"') == 1 and '"Point"' in got[11] and '"Point"' in got[13]


def test_geojson_of_relations_is_that_of_their_wkb_with_each_way_drawn_once(spark, monkeypatch):
    places = [(0, 0), (4, 0), (4, 4), (0, 4), (9, 9)]
    state = StructType([StructField("id", LongType()), StructField("type", StringType()), StructField("now", ENTITY), StructField("before", ENTITY)])
    make = lambda rows: spark.createDataFrame([(r["id"], r["type"], tuple(r[f.name] for f in ENTITY.fields), None) for r in rows], state)
    nodes = make([row(i, NODE, lon=Decimal(x), lat=Decimal(y) / 3) for i, (x, y) in enumerate(places)])
    way = lambda i, refs, **tags: row(i, WAY, nds=[(r,) for r in refs], tags=tags)
    ways = make([way(1, [0, 1, 2]), way(2, [2, 3, 0]), way(3, [0, 1, 2, 3, 0], building="yes"), way(4, [])])
    inner = {10: [(WAY, 1, "outer"), (WAY, 2, "outer")], 11: [(WAY, 3, "")], 12: [(WAY, 1, "")], 13: [(WAY, 1, ""), (WAY, 4, "")], 14: [(WAY, 1, ""), (NODE, 4, "")], 15: [], 16: [(WAY, 99, "")]}
    outer = {20: [(RELATION, 12, ""), (RELATION, 13, "")], 21: [(RELATION, 10, "outer")], 22: [(RELATION, 12, ""), (RELATION, 10, ""), (WAY, 3, "")]}
    areas = {i: dict(tags={"type": "multipolygon"}) for i in (10, 11, 15, 21)}
    h = Histories(nodes, ways, make([row(i, RELATION, m, **areas.get(i, {})) for i, m in (inner | outer).items()]))
    want = {r.id: wkb.to_geojson(*wkb.load(bytes(r.wkb))) for r in render.geometries(h).where("type = 'relation' AND mode = 'in'").collect()}
    times, listed = [], render.vertex_states
    monkeypatch.setattr(render, "vertex_states", lambda n: times.append(n) or listed(n))
    got = {r.id: json.loads(r.value)["geometry"] for r in render.geojson(h).where("type = 'relation'").collect()}
    assert got == want and len(got) == 10
    assert {g["type"] for g in got.values()} == {"Polygon", "MultiPolygon", "MultiLineString", "GeometryCollection"}
    assert len(times) == 1

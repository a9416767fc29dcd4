from __future__ import annotations

import itertools
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geo
from terraloom.geometry import assembly, wkb


def line(*p):
    return np.array(p, float)


def square(x, y, s):
    return line((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))


def W(a):
    return wkb.dump(wkb.LINE, a)


def area_of(g):
    kind, data = wkb.load(g)
    polys = [data] if kind == wkb.POLYGON else data
    return sum(assembly.area(p[0]) - sum(map(assembly.area, p[1:])) for p in polys)


SHAPES = [
    (wkb.POINT, np.array([1.0, 2.5])), (wkb.LINE, line((0, 0), (1, 1))), (wkb.POLYGON, [square(0, 0, 9), square(1, 1, 2)]), (wkb.MULTIPOINT, [np.array([1.0, 2.0])]),
    (wkb.MULTILINE, [line((0, 0), (1, 1)), line((2, 2), (3, 3))]), (wkb.MULTIPOLYGON, [[square(0, 0, 1)], [square(5, 5, 1)]]), (wkb.COLLECTION, [(wkb.POINT, np.array([0.0, 1.0])), (wkb.LINE, line((0, 0), (1, 1)))]),
]


@pytest.mark.parametrize("shape", SHAPES)
def test_wkb_round_trip(shape):
    data = wkb.dump(*shape)
    assert wkb.dump(*wkb.load(data)) == data and not wkb.is_empty(*wkb.load(data))
    assert wkb.to_geojson(*wkb.load(data))["type"] == wkb.NAMES[shape[0]]


def test_ewkb_and_big_endian():
    assert wkb.load(struct.pack("<BIIdd", 1, 0x20000001, 4326, 1, 2))[1].tolist() == [1, 2]
    assert wkb.load(struct.pack(">BIddd", 0, 1001, 1, 2, 3))[1].tolist() == [1, 2]
    assert wkb.to_text(*wkb.load(wkb.dump(wkb.POINT, None))) == "POINT EMPTY"


def test_text_lists_empty_parts():
    empty = line()
    assert wkb.to_text(*wkb.load(wkb.dump(wkb.MULTILINE, [empty, empty]))) == "MULTILINESTRING (EMPTY, EMPTY)"
    assert wkb.to_text(*wkb.load(wkb.dump(wkb.COLLECTION, [(wkb.LINE, empty)]))) == "GEOMETRYCOLLECTION (LINESTRING EMPTY)"
    assert wkb.to_text(wkb.MULTILINE, []) == "MULTILINESTRING EMPTY" and wkb.to_text(wkb.LINE, empty) == "LINESTRING EMPTY"


def test_chains():
    halves = [line((0, 0), (1, 0), (1, 1)), line((0, 0), (0, 1), (1, 1))]
    (ring,) = assembly.chain(halves, rings=True)
    assert ring.tolist() == [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    assert len(assembly.chain([halves[0], halves[1], halves[1]], rings=True)) == 1  # a segment given twice
    with pytest.raises(assembly.AssemblyError):
        assembly.chain(halves[:1], rings=True)
    out = assembly.chain([line((0, 0), (1, 0)), line((5, 5), (6, 6)), line((2, 0), (1, 0))], rings=False)
    assert [x.tolist() for x in out] == [[[0, 0], [1, 0], [2, 0]], [[5, 5], [6, 6]]]
    assert len(assembly.chain([line((1, 0), (2, 0)), line((0, 0), (1, 0))], rings=False)) == 2  # grows at the tail only


def test_nested_rings():
    """Ring parity makes the third ring an outer one, which the union with the first swallows; likewise the inner ones."""
    rings = [square(0, 0, 30), square(2, 2, 20), square(4, 4, 10), square(5, 5, 2)]
    for order in itertools.permutations(rings):
        g = assembly.multipolygon([2] * 4, ["", "inner", "outer", ""], [W(r) for r in order])
        assert area_of(g) == 900 - 400
        kind, data = wkb.load(g)
        assert kind == wkb.POLYGON and len(data) == 2


def test_rings_in_pieces():
    outer = [line((0, 0), (10, 0), (10, 10)), line((0, 10), (0, 0)), line((0, 10), (10, 10))]
    for parts in itertools.permutations(outer):
        g = assembly.multipolygon([2, 2, 2, 2], ["outer", "outer", "outer", "inner"], [*map(W, parts), W(square(1, 1, 3))])
        assert area_of(g) == 91 and len(wkb.load(g)[1]) == 2


def test_shared_edges_dissolve_and_touching_inners_join():
    g = assembly.multipolygon([2, 2], ["outer", "outer"], [W(square(0, 0, 2)), W(square(2, 0, 2))])
    assert wkb.load(g)[0] == wkb.POLYGON and area_of(g) == 8
    g = assembly.multipolygon([2] * 3, ["outer", "inner", "inner"], [W(square(0, 0, 10)), W(square(1, 1, 2)), W(square(3, 1, 2))])
    assert area_of(g) == 92 and len(wkb.load(g)[1]) == 2


def test_what_does_not_count():
    ring = W(square(0, 0, 4))
    assert assembly.multipolygon([2, 2], ["outer", "outer"], [ring, None]) is None
    assert assembly.multipolygon([2], ["outer"], [W(line((0, 0), (1, 1)))]) is None
    assert area_of(assembly.multipolygon([2, 2], ["outer", "outer"], [ring, W(square(1, 1, 5))])) == 16 + 25 - 9  # crossing rings
    g = assembly.multipolygon([2, 1, 2], ["outer", "", "label"], [ring, wkb.dump(wkb.POINT, (1, 1)), W(square(50, 50, 1))])
    assert wkb.load(g)[0] == wkb.POLYGON and area_of(g) == 16
    assert area_of(assembly.multipolygon([2], [None], [wkb.dump(wkb.POLYGON, [square(0, 0, 3), square(1, 1, 1)])])) == 9  # the exterior counts
    assert wkb.is_empty(*wkb.load(assembly.multipolygon([], [], [])))


def test_routes():
    out = dict(assembly.route([2, 2, 1, 2], ["fwd", "fwd", "stop", None], [W(line((0, 0), (1, 0))), W(line((2, 0), (1, 0))), wkb.dump(wkb.POINT, (0, 0)), W(line((9, 9), (8, 8)))]))
    assert wkb.to_text(*wkb.load(out["fwd"])) == "LINESTRING (0 0, 1 0, 2 0)" and set(out) == {"fwd", ""}
    assert assembly.route([2], [""], [None]) is None
    (made,) = assembly.route([2, 2], ["", ""], [W(line((0, 0), (1, 0))), W(line((5, 5), (6, 6)))])
    assert wkb.load(made[1])[0] == wkb.MULTILINE


def test_containment_and_validity():
    assert assembly.contains(square(0, 0, 4), square(1, 1, 2)) and not assembly.contains(square(1, 1, 2), square(0, 0, 4))
    assert not assembly.contains(square(0, 0, 4), square(3, 3, 4)) and assembly.contains(square(0, 0, 4), square(0, 0, 2))
    bow = line((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))
    assert not assembly.valid(wkb.POLYGON, [bow]) and assembly.valid(wkb.POLYGON, [square(0, 0, 4), square(1, 1, 1)])
    assert not assembly.valid(wkb.POLYGON, [square(0, 0, 1), square(5, 5, 1)]) and not assembly.valid(wkb.LINE, line((1, 1), (1, 1)))


def test_st_functions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 2.0), (None, 1.0)], "x double, y double").select(geo.st_point("x", "y").alias("g"))
    out = df.select("g", geo.st_astext("g").alias("t"), geo.st_isempty("g").alias("e"), geo.st_isvalid("g").alias("v"), geo.st_transform(F.col("g")).alias("m")).collect()
    assert [(r.t, r.e, r.v) for r in out] == [("POINT (1 2)", False, True), ("", True, False), ("", True, False)]
    x, y = wkb.load(bytes(out[0].m))[1]
    assert abs(x - 111319.49079327358) < 1e-6 and abs(y - 222684.20850554405) < 1e-6
    assert np.allclose(geo.unmercator(geo.mercator(np.array([[12.5, -60.25]]))), [[12.5, -60.25]])


@pytest.mark.parametrize("seed", range(12))
def test_union_of_any_rings(seed):
    """Random overlapping, touching and nested shapes on a grid, and turned ones off it, against point tests."""
    rng = np.random.default_rng(seed)
    rings = []
    for _ in range(rng.integers(2, 9)):
        x, y, w, h = rng.integers(0, 9, 2).tolist() + rng.integers(1, 6, 2).tolist()
        r = line((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))
        if seed % 3 == 2:
            a = rng.uniform(0, 3)
            r = r @ np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
            r[-1] = r[0]
        rings.append(r[::-1] if rng.random() < 0.5 else r)
    shells, holes = assembly.dissolve(rings)
    for p in rng.uniform(-12, 15, (400, 2)):
        want = any(assembly.inside(p, r) > 0 for r in rings)
        assert (sum(assembly.inside(p, s) > 0 for s in shells) - sum(assembly.inside(p, h) > 0 for h in holes) == 1) == want


def test_overlapping_outers_are_joined():
    g = assembly.multipolygon([2, 2, 2], ["outer", "outer", "inner"], [W(square(0, 0, 4)), W(square(2, 2, 4)), W(square(1, 1, 0.5))])
    assert area_of(g) == 16 + 16 - 4 - 0.25
    kind, data = wkb.load(g)
    assert kind == wkb.POLYGON and len(data) == 2
    apart = assembly.multipolygon([2, 2], ["outer", "outer"], [W(square(0, 0, 1)), W(square(1, 1, 1))])  # touch at a corner
    assert area_of(apart) == 2 and wkb.load(apart)[0] == wkb.MULTIPOLYGON

from __future__ import annotations

import bz2
import gzip
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from terraloom.operators import closure
from terraloom.operators.augment import latest_origin, with_origin
from terraloom.schema import STORED, entities
from terraloom.sources import paths
from terraloom.sources.changes import read_changes
from terraloom.sources import store
from terraloom.sources.store import Index, lookup, merge_files, read_snapshot, read_store, write_store
from terraloom.streaming.loop import Loop, change_stream


def node(i, v, lon, lat, **tags):
    return f'<node id="{i}" version="{v}" timestamp="2024-01-{v:02d}T00:00:00Z" changeset="9" uid="1" user="u" lat="{lat}" lon="{lon}">' + "".join(f'<tag k="{k}" v="{x}"/>' for k, x in tags.items()) + "</node>"


def way(i, v, nds, **tags):
    return f'<way id="{i}" version="{v}" timestamp="2024-01-{v:02d}T00:00:00Z" changeset="9" uid="1" user="u">' + "".join(f'<nd ref="{n}"/>' for n in nds) + "".join(f'<tag k="{k}" v="{x}"/>' for k, x in tags.items()) + "</way>"


def relation(i, v, members, **tags):
    return f'<relation id="{i}" version="{v}" timestamp="2024-01-{v:02d}T00:00:00Z" changeset="9" uid="1" user="u">' + "".join(f'<member type="{t}" ref="{r}" role="{o}"/>' for t, r, o in members) + "".join(f'<tag k="{k}" v="{x}"/>' for k, x in tags.items()) + "</relation>"


def change(**blocks):
    return '<?xml version="1.0"?><osmChange version="0.6">' + "".join(f"<{a}>{b}</{a}>" for a, b in blocks.items()) + "</osmChange>"


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """Plans over a handful of rows: compiling them would take most of the time."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


class World:
    """A loop over files made here; shown(seq): {(type, id, visible): geometry} of a step's features."""

    def __init__(self, spark, base=""):
        self.spark, self.dir = spark, tempfile.mkdtemp()
        self.loop, self.n = Loop(spark, f"{self.dir}/root", compact_every=2), 1
        rows = read_changes(spark, self.file(0, change(create=base) if base else change()))
        self.loop.create(rows)

    def file(self, seq, text, suffix=""):
        path = f"{self.dir}/{seq:03d}.osc{suffix}"
        opener = {"": open, ".gz": gzip.open, ".bz2": bz2.open}[suffix]
        with opener(path, "wt") as f:
            f.write(text)
        return path

    def apply(self, **blocks):
        self.file(self.n, change(**blocks))
        self.loop.step(self.n, read_changes(self.spark, f"{self.dir}/{self.n:03d}.osc"))
        self.n += 1
        return self.shown(self.n - 1)

    def shown(self, seq):
        out = {}
        for r in self.spark.read.text(f"{self.dir}/root/features/seq={seq}").collect():
            f = json.loads(r.value)
            p = f["properties"]
            assert (p["type"], p["id"], p["visible"]) not in out
            out[p["type"], p["id"], p["visible"]] = f["geometry"]
        return out


BASE = (
    node(1, 1, 0, 0) + node(2, 1, 1, 0) + node(3, 1, 1, 1) + node(4, 1, 5, 5) + node(5, 1, 7, 7) + way(10, 1, [1, 2, 3]) + way(11, 1, [1, 2, 3, 1], building="yes") + way(5, 1, [4, 5])
    + relation(20, 1, [("way", 10, ""), ("way", 5, "")]) + relation(21, 1, [("relation", 20, "")]) + relation(5, 1, [("node", 5, "")]) + relation(22, 1, [("way", 11, "outer")], type="multipolygon")
    + way(12, 1, [1, 999]) + relation(30, 1, [("relation", 31, ""), ("node", 4, "")]) + relation(31, 1, [("relation", 30, "")])
)


@pytest.fixture(scope="module")
def world(spark):
    return World(spark, BASE)


def test_moving_a_node_moves_all_above_it(world):
    out = world.apply(modify=node(2, 2, 1, -1))
    assert out["node", 2, True]["coordinates"] == [1.0, -1.0] and out["node", 2, False]["coordinates"] == [1.0, 0.0]
    assert out["way", 10, True]["coordinates"][1] == [1.0, -1.0] and out["way", 10, False]["coordinates"][1] == [1.0, 0.0]
    assert out["way", 11, True]["type"] == "Polygon" and out["relation", 22, False]["type"] == "Polygon"
    assert out["relation", 20, True]["type"] == "MultiLineString" and out["relation", 21, False]["coordinates"][0][1] == [1.0, 0.0]
    assert {k[:2] for k in out} == {("node", 2), ("way", 10), ("way", 11), ("relation", 20), ("relation", 21), ("relation", 22)}  # way 12 lacks a node
    # The same file again: nothing new in the index, the same features.
    edges = world.loop.index.read().count()
    world.loop.step(1, read_changes(world.spark, f"{world.dir}/001.osc"))
    assert world.loop.index.read().count() == edges and world.shown(1) == out


def test_ids_are_told_apart_by_type_and_cycles_end(world):
    out = world.apply(modify=node(5, 2, 8, 8) + way(5, 2, [4, 5], highway="x") + relation(5, 2, [("node", 5, "x")]))
    assert {("node", 5), ("way", 5), ("relation", 5)} <= {k[:2] for k in out}
    out = world.apply(modify=node(4, 3, 6, 6))
    assert ("relation", 30, True) in out and ("relation", 31, True) in out


def test_way_edits_and_deletions(world):
    out = world.apply(modify=way(10, 4, [1, 3]))  # drops a vertex
    assert len(out["way", 10, True]["coordinates"]) == 2 and len(out["way", 10, False]["coordinates"]) == 3
    out = world.apply(delete=way(5, 5, []))
    assert out["way", 5, False]["type"] == "LineString" and ("way", 5, True) not in out
    out = world.apply(delete=node(4, 6, 0, 0))
    assert out["node", 4, False]["coordinates"] == [6.0, 6.0] and ("node", 4, True) not in out
    out = world.apply(create=node(4, 7, 2, 2))  # undeleted
    assert out["node", 4, True]["coordinates"] == [2.0, 2.0] and ("node", 4, False) not in out


def test_versions_in_one_file(spark):
    w = World(spark, node(1, 1, 0, 0))
    out = w.apply(modify=node(1, 2, 1, 1) + node(1, 3, 2, 2), create=node(7, 1, 3, 3), delete=node(7, 2, 0, 0))
    assert out == {("node", 1, True): {"type": "Point", "coordinates": [2.0, 2.0]}, ("node", 1, False): {"type": "Point", "coordinates": [0.0, 0.0]}}
    assert w.apply() == {}


def test_run_compacts_and_keeps_the_tail(spark):
    w = World(spark, BASE)
    for k in range(1, 4):
        w.file(k, change(modify=node(1, k + 1, k, k)))
    assert w.loop.run(w.dir + "/CCC.osc", 1, 3) == 3
    assert read_store(spark, f"{w.dir}/root/store").where("type = 'node' AND id = 1").count() == 3  # two steps moved
    assert w.loop._delta().count() == 1
    assert w.shown(3)["node", 1, False]["coordinates"] == [2.0, 2.0]
    with pytest.raises(Exception):
        w.loop.run(w.dir + "/CCC.osc", 50, 50, attempts=2, sleep=lambda s: None)


def test_stream_takes_files_one_by_one(spark):
    w, src = World(spark, BASE), tempfile.mkdtemp()
    for k, suffix in ((1, ".gz"), (2, ".bz2")):
        p = w.file(k, change(modify=node(1, k + 1, k, k)), suffix)
        os.utime(p, (k, k))
        os.rename(p, f"{src}/{k}.osc{suffix}")
        os.utime(f"{src}/{k}.osc{suffix}", (k * 100, k * 100))
    q = w.loop.stream(change_stream(spark, src), f"{w.dir}/ck")
    q.awaitTermination()
    assert q.exception() is None
    assert w.shown(2)["node", 1, True]["coordinates"] == [2.0, 2.0] and w.shown(2)["node", 1, False]["coordinates"] == [1.0, 1.0]


def test_numbered_files_are_followed(spark):
    import time

    w = World(spark, BASE)
    w.file(1, change(modify=node(1, 2, 1, 1)))
    q = w.loop.follow(w.dir + "/CCC.osc", 1, f"{w.dir}/ck2", end=2)
    try:
        until = time.time() + 120
        while not os.path.exists(f"{w.dir}/root/features/seq=1/_SUCCESS") and time.time() < until and q.isActive:
            time.sleep(0.5)
        w.file(2, change(modify=node(1, 3, 2, 2)))
        while not os.path.exists(f"{w.dir}/root/features/seq=2/_SUCCESS") and time.time() < until and q.isActive:
            time.sleep(0.5)
        assert q.exception() is None
    finally:
        q.stop()
    assert w.shown(2)["node", 1, False]["coordinates"] == [1.0, 1.0]


def test_change_files(spark):
    w = World(spark)
    p = w.file(9, change(create=way(1, 1, [3, 2, 3], a="b"), modify=relation(2, 2, [("node", 1, "r")]), delete=node(3, 3, 4, 5, k="v")), ".gz")
    out = {r.type: r for r in read_changes(spark, p).collect()}
    assert [n.ref for n in out["way"].nds] == [3, 2, 3] and out["way"].tags == {"a": "b"} and out["way"].visible
    assert [tuple(m) for m in out["relation"].members] == [("node", 1, "r")]
    d = out["node"]
    assert (d.visible, d.lat, d.tags, d.changeset, d.version, d.nds) == (False, None, {}, None, 3, [])


def test_store_round_trip_and_pruning(spark):
    rows = [(i, t, {"k": str(i)}) for i in (-5, 3, 2048, 2049, 77777) for t in ("node", "way")]
    df = entities(spark.createDataFrame(rows, "id long, type string, tags map<string,string>"))
    at = tempfile.mkdtemp()
    write_store(df, f"{at}/s", "overwrite")
    assert read_store(spark, f"{at}/s").count() == 10
    want = df.where("id IN (-5, 77777) AND type = 'way'").select("p", "id", "type")
    got = lookup(read_store(spark, f"{at}/s"), want)
    assert sorted((r.id, r.type, r.tags["k"]) for r in got.collect()) == [(-5, "way", "-5"), (77777, "way", "77777")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "p#" in plan.split("PartitionFilters")[1][:40] and "In(id" in plan
    df.select(*[f.name for f in STORED.fields]).write.orc(f"{at}/snap")
    assert sorted(r.p for r in read_snapshot(spark, f"{at}/snap").select("p").collect()) == sorted(r.p for r in df.select("p").collect())


def test_index_is_a_set(spark):
    at = tempfile.mkdtemp()
    i = Index(spark, at)
    e = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    i.replace(e)
    i.append(e.unionAll(spark.createDataFrame([(5, 6)] * 2, "a long, b long")))
    assert sorted(map(tuple, i.read().collect())) == sorted(map(tuple, i.read("b").collect())) == [(1, 2), (2, 3), (5, 6)]


def brute_closure(edges):
    reach = set(edges)
    while True:
        more = {(a, d) for a, b in reach for c, d in edges if b == c} - reach
        if not more:
            return {(a, b) for a, b in reach if a != b}
        reach |= more


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_increments_add_up_to_the_whole(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(25), rng.randrange(25)) for _ in range(40)}
    make = lambda e: spark.createDataFrame(sorted(e), "a long, b long")
    assert {tuple(r) for r in closure.transitive_closure(make(edges)).collect()} == brute_closure(edges)
    first = {e for e in edges if rng.random() < 0.5} or set(list(edges)[:1])
    index = closure.transitive_closure(make(first))
    new = closure.new_index_edges(index, make(edges - first))
    assert {tuple(r) for r in index.unionByName(new).collect()} == brute_closure(edges)
    assert closure.new_index_edges(closure.transitive_closure(make(edges)), make(edges)).count() == 0


def test_repeated_rows_keep_the_best_origin(spark):
    df = spark.createDataFrame([(1, "node", 1, "2024-01-01", {"a": "b"})], "id long, type string, version long, timestamp string, tags map<string,string>")
    out = latest_origin(with_origin(df, "storage").unionByName(with_origin(df, "memory"))).collect()
    assert [r.origin for r in out] == ["memory"]


def test_paths(spark):
    assert paths.path_of("/x/AAA/BBB/CCC.osc", 1_234_567) == "/x/001/234/567.osc"
    df = spark.createDataFrame([(0,), (42,), (1_234_567,)], "n long").select(paths.sequence_path(F.lit("AAA/BBB/CCC"), F.col("n")).alias("p"))
    assert [r.p for r in df.collect()] == ["000/000/000", "000/000/042", "001/234/567"]
    assert list(paths.numbers(3, 5)) == [3, 4, 5] and next(paths.numbers(9, -1)) == 9
    waits = []

    def bad():
        raise OSError("no")

    with pytest.raises(OSError):
        paths.with_retries(bad, sleep=waits.append)
    assert waits == [2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 256.0]


def test_an_index_is_mended_after_a_stop_between_its_copies(spark, monkeypatch):
    i = Index(spark, tempfile.mkdtemp())
    make = lambda *e: spark.createDataFrame(e, "a long, b long")
    i.replace(make((1, 2)))
    real = Index._write

    def stops(self, key, edges, mode):
        if key == "b":
            raise OSError("stopped")
        real(self, key, edges, mode)

    monkeypatch.setattr(Index, "_write", stops)
    with pytest.raises(OSError):
        i.append(make((1, 2), (3, 4)))
    monkeypatch.setattr(Index, "_write", real)
    i.append(make((1, 2), (3, 4)))
    assert sorted(map(tuple, i.read("a").collect())) == sorted(map(tuple, i.read("b").collect())) == [(1, 2), (3, 4)]


def test_look_ups_prune_the_copy_of_their_key(spark):
    i = Index(spark, tempfile.mkdtemp())
    i.replace(spark.range(200).selectExpr("id AS a", "id * 7 % 50 AS b"))
    keys = spark.createDataFrame([(3,), (49,)], "v long")
    for by in ("a", "b"):
        got = i.about(by, keys)
        assert sorted(map(tuple, got.collect())) == sorted((a, a * 7 % 50) for a in range(200) if (a if by == "a" else a * 7 % 50) in (3, 49))
        assert f"In({by}, [3,49])" in got._jdf.queryExecution().executedPlan().toString()


def test_partitions_of_many_files_are_merged(spark):
    at = f"{tempfile.mkdtemp()}/s"
    row = lambda i, v: entities(spark.createDataFrame([(i, "node", v)], "id long, type string, version long"))
    write_store(row(1, 0), at, "overwrite")
    for v in range(1, 4):
        write_store(row(1, v), at)
    write_store(row(1, 3).unionByName(row(2, 1)), at)
    assert merge_files(spark, at, most=3) == 1 and merge_files(spark, at, most=3) == 0
    assert sorted((r.id, r.version) for r in read_store(spark, at).collect()) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 1)]


def test_a_step_leaves_no_work_tables(spark):
    w = World(spark, BASE)
    from terraloom.scratch import shared_folder

    work = shared_folder(spark).removeprefix("file://") + "/work"
    before = set(os.listdir(work))
    w.apply(modify=node(1, 2, 3, 3))
    assert set(os.listdir(work)) <= before


def test_index_in_a_database(spark):
    url, given = "jdbc:derby:memory:terraloom;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    make = lambda *e: spark.createDataFrame(e, "a long, b long")
    store.write_jdbc_index(make(*[(i, i % 9) for i in range(3000)], (5, 5)), url, "edges", given)
    keys = spark.range(1, 2500).selectExpr("id AS v")
    assert store.lookup_jdbc_index(spark, url, "edges", given, "a", keys).rdd.getNumPartitions() == 3
    assert store.lookup_jdbc_index(spark, url, "edges", given, "a", keys).count() == 2499
    assert sorted(map(tuple, store.lookup_jdbc_index(spark, url, "edges", given, "b", make((0, 8)).select(F.col("b").alias("v"))).collect())) == [(i, 8) for i in range(3000) if i % 9 == 8]
    store.append_jdbc_index(make((1, 1), (2, 2), (7, 70), (9000, 1)), url, "edges", given)
    whole = store.read_jdbc_index(spark, url, "edges", given)
    assert whole.count() == 3002 and whole.rdd.getNumPartitions() > 1
    names = spark.read.jdbc(url, "(SELECT COUNT(*) n FROM SYS.SYSCONGLOMERATES WHERE CONGLOMERATENAME IN ('IDX_EDGES_A', 'IDX_EDGES_B')) t", properties=given).first()
    assert names[0] == 2
    with pytest.raises(ValueError):
        store.write_jdbc_index(make((1, 1)), url, "x; DROP TABLE edges", given)


def test_remote_files(spark):
    import functools
    import http.server
    import threading

    folder = tempfile.mkdtemp()
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(http.server.SimpleHTTPRequestHandler, directory=folder))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_address[1]}/001.osc.gz"
        assert not paths.present(url) and not paths.present(f"{folder}/001.osc.gz")
        with gzip.open(f"{folder}/001.osc.gz", "wt") as f:
            f.write(change(create=node(1, 1, 2, 3)))
        assert paths.present(url) and paths.present(f"file://{folder}/001.osc.gz")
        copy = paths.fetched(spark, url, f"file://{tempfile.mkdtemp()}")
        assert [r.id for r in read_changes(spark, copy).collect()] == [1] and paths.fetched(spark, "/x", "y") == "/x"
    finally:
        server.shutdown()


def test_late_edits_are_ordered_by_their_time(spark):
    w = World(spark, node(1, 1, 0, 0) + node(2, 1, 9, 9))
    w.apply(modify=node(1, 5, 5, 5))
    out = w.apply(modify=node(1, 3, 3, 3))  # an edit older than the one before
    assert out["node", 1, True]["coordinates"] == [3.0, 3.0] and out["node", 1, False]["coordinates"] == [5.0, 5.0]


def test_external_table(spark):
    at = tempfile.mkdtemp()
    rows = entities(spark.createDataFrame([(1, "node"), (5000, "way")], "id long, type string"))
    write_store(rows, f"{at}/t", "overwrite", table="terraloom_entities")
    try:
        assert spark.sql("SELECT count(*) FROM terraloom_entities WHERE p = 1").first()[0] == 1
        assert read_store(spark, f"{at}/t").count() == 2
    finally:
        spark.sql("DROP TABLE terraloom_entities")


def test_nested_extracts_and_step_logs(spark, caplog):
    import logging

    at = tempfile.mkdtemp()
    rows = entities(spark.createDataFrame([(1, "node"), (2, "node")], "id long, type string")).select(*[f.name for f in STORED.fields])
    rows.where("id = 1").write.orc(f"{at}/x/a")
    rows.where("id = 2").write.orc(f"{at}/x/b")
    assert read_snapshot(spark, f"{at}/x", recursive=True, glob="*.orc").count() == 2 and read_snapshot(spark, f"{at}/x", recursive=True, glob="*.none").count() == 0
    w = World(spark, node(1, 1, 0, 0) + way(2, 1, [1]))
    with caplog.at_level(logging.INFO, logger="terraloom"):
        w.apply(modify=node(1, 2, 1, 1))
    assert "step 1: 1 rows changed, 0 index edges new, 2 entities wanted, 3 rows found" in caplog.text


def test_log_levels_by_name(spark):
    from terraloom.session import session

    s = session("x", log_level="ERROR", log_levels={"terraloom.example": "INFO"})
    assert s._jvm.org.apache.logging.log4j.LogManager.getLogger("terraloom.example").getLevel().toString() == "INFO"

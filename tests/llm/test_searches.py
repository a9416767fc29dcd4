from __future__ import annotations

import dataclasses
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm import ann, decontaminate, neardup, runtime
from terraloom.llm.components import connected_components
from terraloom.llm.runtime import Scratch


def grams(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def brute_components(rows, k=2, percent=80):
    sets = [(d, grams(t, k)) for d, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                up[hi] = lo
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rng = random.Random(width)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(30):
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 12, 60, 200]))
        for _ in range(rng.choice([1, 2, 8])):
            t = list(base)
            for _ in range(int(len(t) * rng.choice([0, 0.02, 0.05, 0.1]))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((n, " ".join(t)))
            n += 1
    chain = [f"c{i}" for i in range(100)]  # each links to the next only
    for k in range(8):
        rows.append((n + k, " ".join(chain[3 * k : 3 * k + 60])))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "W1  w2"), (5004, "w1 W2"), (None, "w1 w2"), (5005, "w1 w2"), (5005, "w1 w2"), (5006, "long " + " ".join(f"u{i}" for i in range(30_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "label": F.lit("x"), "key": F.lit(2)})
    p = neardup.NearDupParams(width=width)
    out = neardup.near_duplicates(df, p).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute_components(rows, width)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in out)
    kept = [r.doc_id for r in neardup.keep_one(df, p).collect()]
    want = {c for d, _, c in brute_components(rows, width) if d is not None}
    assert sorted(x for x in kept if x is not None) == sorted(want) and kept.count(None) == 1
    assert neardup.near_duplicates(df.limit(0), p).count() == 0


def test_hot_bucket_with_outsiders(spark):
    rng = random.Random(7)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for d in range(300):
        t = list(base)
        for _ in range(rng.choice([1, 5, 9])):
            t[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute_components(rows)


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (201, 200), (200, 201)] + [(300 + rng.randrange(50), 300 + rng.randrange(50)) for _ in range(40)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in connected_components(df, Scratch(spark, "t"), "cc").collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert {k: v for k, v in got.items()} == {k: v for k, v in up.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert connected_components(df.limit(0), Scratch(spark, "t"), "none").count() == 0


def alnum(text):
    return re.findall(r"[a-z0-9'\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_containment_matches_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 5, 9, 40, 150])))) for i in range(40)] + [(100, None), (101, "?!"), (102, "É, é!"), (103, items_dup := "v1 v2 v3 v4 v5 v6")] + [(103, items_dup)]
    docs = []
    for d in range(150):
        t = rng.choices(vocab, k=rng.choice([3, 30, 300, 2000]))
        if d % 2:
            w = alnum(rng.choice(items)[1])
            for _ in range(int(len(w) * rng.choice([0, 0.03, 0.1]))):
                w[rng.randrange(len(w))] = "odd"
            at = rng.randrange(len(t))
            t[at:at] = [x.upper() + "," for x in w]
        docs.append((d, " ".join(t)))
    docs += [(900, None), (901, ""), (902, "x É -- é y"), (None, items_dup), (903, items_dup), (903, items_dup)]
    want = []
    for d, t in docs:
        for i, x in items:
            w = alnum(x)
            k = min(5, len(w))
            if k:
                run = lambda v, k=k: {tuple(v[j : j + k]) for j in range(len(v) - k + 1)}
                a, b = run(w), run(alnum(t))
                if 100 * len(a & b) >= 80 * len(a):
                    want.append((d, i, len(a & b), len(a)))
    D = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    B = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 60):
        out = decontaminate.contained_items(D, B, decontaminate.ContainmentParams(block_shingles=block)).collect()
        assert sorted(((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in out), key=str) == sorted(want, key=str)
    assert len(want) > 40
    kept = decontaminate.without_contaminated(D, B).select("doc_id").collect()
    assert sorted((r[0] for r in kept), key=str) == sorted((d for d, _ in docs if d is None or d not in {w[0] for w in want}), key=str)
    assert decontaminate.contained_items(D, B.limit(0)).count() == 0 == decontaminate.contained_items(D.limit(0), B).count()


def test_window_sketches_find_short_items_in_long_documents():
    """Without the probes: whole items within documents a thousand times as long are candidates, others hardly ever."""
    rng, p = random.Random(12), decontaminate.ContainmentParams()
    words_of = lambda t: decontaminate.tx.tokens(t, decontaminate.GAP)[0]
    vocab = [f"v{i}" for i in range(5000)]
    items = [rng.choices(vocab, k=rng.choice([8, 20, 40, 90])) for _ in range(120)]
    sets = [decontaminate.tx.distinct(decontaminate.tx.shingle_stream(words_of(" ".join(t)), 5)) for t in items]
    block = decontaminate.ItemBlock([(i, 5, s) for i, s in enumerate(sets)], p)
    hit = wrong = 0
    for i, t in enumerate(items):
        doc = rng.choices(vocab, k=20_000)
        at = rng.randrange(len(doc))
        found = block.sketched(words_of(" ".join(doc[:at] + t + doc[at:])), 5)
        hit, wrong = hit + (i in found), wrong + len(found - {i})
    assert hit >= 0.95 * len(items) and wrong <= 2
    values = decontaminate.minhashes(np.arange(50, dtype=np.uint64), 4)
    assert (decontaminate.window_sketches(values, 8)[:, 1] == values[:, 8:24].min(axis=1)).all() and (decontaminate.window_sketches(values, 64)[:, 0] == values.min(axis=1)).all()


@pytest.mark.parametrize("most", [10, 1000])
def test_rows_by_ids(spark, monkeypatch, most):
    """Above the broadcast bound a Bloom filter comes first; the result is the same."""
    monkeypatch.setattr(runtime, "BROADCAST_IDS", most)
    tmp = Scratch(spark, "t")
    df = spark.range(-500, 500).withColumns({"__ID": F.lit("clash"), "__maybe": F.lit(1)}).unionByName(spark.sql("SELECT null AS id, 'n' AS __ID, 2 AS __maybe"))
    ids = tmp.write(spark.range(-500, 500, 3).unionAll(spark.range(9000, 9050)), "ids")
    semi, anti = runtime.by_ids(df, "id", ids, "left_semi"), runtime.by_ids(df, "id", ids, "left_anti")
    assert semi.columns == anti.columns == df.columns
    assert sorted(r.id for r in semi.collect()) == list(range(-500, 500, 3))
    assert sorted(r.id for r in anti.where("id IS NOT NULL").collect()) == [i for i in range(-500, 500) if (i + 500) % 3] and anti.where("id IS NULL").count() == 1


def test_a_key_of_a_large_group_costs_its_outsiders(spark):
    """Members of one component that share rare shingles with few outsiders: what meets grows with their number, not its square."""
    p, met = neardup.NearDupParams(), []
    for n in (60, 240):
        rows = [(d, neardup.tx.shingle_set(" ".join([f"b{i}" for i in range(40)] + [f"z{d}"]), 2).tobytes()) for d in range(n + 2)]
        sets = spark.createDataFrame(rows, "id long, grams binary")
        rest = spark.createDataFrame([(d, d if d >= n else 0, 0) for d, _ in rows], "rep long, label long, main long")
        met.append(neardup._meetings(rest, sets, p).count())
        assert neardup._open_pairs(rest, sets, p).count() == 2 * n + 1
    assert met[1] <= 6 * met[0]


def test_sketches_hold_a_value_that_any_container_has():
    for n in range(1, 400):
        k = decontaminate.sketch_size(n, 80)
        assert k > n - decontaminate.needed(n, 80) and k <= n


def brute_nearest(rows, every, top):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            s = sorted(((-float(x @ y), i) for i, y in good if i != q))[:top]
            out[q] = [(i, -v) for v, i in s]
    return out


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24)).astype(np.float32) * rng.uniform(0.5, 1.5, (1500, 1)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[3][1]) for i in range(60)]  # copies
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [None] + [1.0] * 23), (3004, [float("nan")] * 24), (3005, [float("inf")] * 24), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    got: dict = {}
    for r in ann.nearest(df, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, g in got.items():
        g.sort()
        assert [k for k, _, _ in g] == list(range(1, 21))
        assert [(-s, i) for _, i, s in g] == sorted((-s, i) for _, i, s in g)
        hits += len({i for _, i, _ in g} & {i for i, _ in want[q]}) / 20
    assert hits / len(got) >= 0.95
    assert [i for _, i, _ in sorted(got[2000])][:3] == [i for i, _ in want[2000]][:3]


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i % 3 + 1), 1.0]) for i in range(7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest(df, 2).collect())
    want = sorted((q, k + 1, i) for q, g in brute_nearest(rows, 2, 20).items() for k, (i, _) in enumerate(g))
    assert got == want
    assert ann.nearest(df.limit(0), 2).count() == 0
    assert ann.nearest(df.limit(1), 2).count() == 0


def recall_of(df, rows, every, p=ann.AnnParams()):
    got: dict = {}
    for r in ann.nearest(df, every, p).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    hits = []
    for i, v in rows:
        if i % every == 0:
            s = x @ np.array(v, float)
            s[ids == i] = -np.inf
            hits.append(len(set(got[i]) & set(ids[np.lexsort((ids, -s))[: p.top]].tolist())) / p.top)
    return np.array(hits)


def test_the_search_visits_a_minor_part(spark):
    """With small lists and leaves the graph is built by many rounds, and a query is compared with few of the nodes."""
    x = np.random.default_rng(5).normal(size=(5000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    p = ann.AnnParams(neighbours=24, sampled=12, trees=3, leaf=24, leaf_best=8, most_pivots=32, most_leaf=48, expand=24, beam=40, entries=32)
    assert recall_of(df, rows, 40, p).mean() >= 0.9
    tmp = Scratch(spark, "t")
    nodes = ann.node_table(df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), tmp, 12)
    queries = nodes.where("id % 40 = 0").select(F.col("id").alias("q"), "part", "raw")
    graph = ann.build_graph(nodes, tmp, p)
    best = np.argsort(-(x @ x.T), axis=1)[:, 1:21]  # of one norm, so that products and cosines have one order
    held = {r.id: np.frombuffer(r.nb, np.int64)[:20] for r in graph.select("id", "nb").collect()}
    whole = np.mean([len(np.intersect1d(held[i], best[i])) / 20 for i in range(5000)])
    assert whole >= 0.8 and abs(ann.list_recall(graph, nodes, dataclasses.replace(p, checked=2000)) - whole) < 0.05
    seen = [r.seen for r in ann.search(queries, graph, nodes, tmp, p).select("q", "seen").distinct().collect()]
    assert len(seen) == 125 and max(seen) < 5000 * 0.2


def test_lengths_and_repeated_ids(spark):
    """Each length is searched among its own; an id with several vectors is asked for each, and found once."""
    rows = [(i, [float(i % 5), 1.0]) for i in range(10)] + [(i, [1.0, float(i), 2.0]) for i in range(20, 26)] + [(4, [9.0, 9.0]), (4, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, 4).collect())
    want = []
    for q, v in {(q, tuple(v)) for q, v in rows if q % 4 == 0}:
        best: dict = {}
        for i, w in rows:
            if i != q and len(w) == len(v):
                best[i] = max(best.get(i, -1.0), sum(a * b for a, b in zip(v, w, strict=True)))
        want += [(q, k + 1, i, s) for k, (i, s) in enumerate(sorted(best.items(), key=lambda e: (-e[1], e[0]))[:20])]
    assert got == sorted(want)


def test_near_copies_and_one_huge_norm(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:2500] = x[0] + rng.normal(size=(2500, 24)) * 0.0003
    x[3999] *= 5000
    x = x.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    hits = recall_of(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows, 40)
    assert hits.mean() >= 0.95 and hits.min() >= 0.5

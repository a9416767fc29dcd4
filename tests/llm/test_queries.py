from __future__ import annotations

import random
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from terraloom.llm import queries


@pytest.fixture(scope="module")
def folder(spark):
    """All tables, small, with nulls, repeats, empty texts and extra columns of names that the operators use."""
    rng, at = random.Random(9), tempfile.mkdtemp()
    tongue = {"aa": "abcdefg", "bb": "ghijklm"}
    docs, labels = [], []
    for i in range(240):
        lang = rng.choice(list(tongue))
        w = ["".join(rng.choices(tongue[lang], k=rng.randint(2, 8))) for _ in range(rng.randint(20, 60))]
        for k in range(7, len(w), 8):
            w[k] += "."
        bad, toxic = i % 5 == 0, i % 3 == 0
        t = " ".join(x + "###" if bad else x for x in w) + (" you scum." if toxic else ".")
        docs.append((i, t, lang, f"s{i % 4}"))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000, None, None, None), (1001, "", "aa", "s1"), (1002, docs[0][1], "aa", "s1"), (1002, docs[0][1], "aa", "s1"), (None, "12 34", "bb", None), (1003, "x" * 200_000, "aa", "s2")]
    labels += [(None, 1, 1), (5000, 0, 0), (7, None, None), (1001, 3, 9)]
    clash = {n: F.lit("clash") for n in ("score", "label", "held_out", "__text", "id", "h", "t", "src")}

    def put(rows, schema, name):
        spark.createDataFrame(rows, schema).withColumns(clash).write.parquet(f"{at}/{name}.parquet")

    put(docs, "doc_id long, text string, lang string, source string", "documents")
    put(labels, "doc_id long, quality int, toxic int", "labels")
    put([(k, docs[k][1][:90]) for k in range(1, 6)] + [(9, None), (None, "")], "item_id long, text string", "benchmark")
    put([(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(90)] + [(100, None), (101, [0.0] * 6), (None, [1.0] * 6)], "vec_id long, embedding array<float>", "embeddings")
    put([(1, "http://a.example.org/es/x?y", "<p>hi</p>" * 40), (2, None, None), (3, "HTTP://X.com/fr/", "<p>hi</p>" * 40), (4, "http://", "")], "page_id long, url string, html string", "pages")
    put([(1, 0, "user", "hi </s>"), (1, 1, "assistant", None), (2, 0, None, "x"), (2, 0, None, "x")], "conv_id long, turn long, role string, text string", "conversations")
    return at


WANT = {
    "op1_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op4_nn_descent": "query_id bigint, rank int, vec_id bigint, score double",
    "op5_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op7_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_source_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_decontaminate": "doc_id bigint, item_id bigint, shared int, item_shingles int, containment double",
}
ROWS = {"op1_chat_format": 3, "op3_warc": 4, "op4_nn_descent": 100, "op6_url_filter": 4} | dict.fromkeys(("op2_toxicity", "op5_minhash_dedup", "op7_quality", "op8_language_id", "op9_source_mix"), 246)
HELD = {"op2_toxicity": (5, 0, 0.5), "op7_quality": (4, 2, 0.7), "op8_language_id": (3, 1, None)}


@pytest.mark.parametrize("name", WANT)
def test_query(spark, folder, name):
    made = queries.QUERIES[name](spark, folder)
    kinds = dict(made.dtypes)
    want = dict(c.split() for c in WANT[name].split(", "))
    assert {c: kinds[c] for c in want} == want
    rows = made.collect()
    assert len(rows) == ROWS[name] if name in ROWS else rows
    if name in HELD:
        mod, rest, cut = HELD[name]
        for r in rows:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == rest) and 0 <= r.score <= 1
            assert cut is None or r.predicted == int(r.score >= cut)
    if name == "op8_language_id":
        assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1000, 1001)} == {1000: "und", 1001: "und"}
    if name == "op9_source_mix":
        assert all(0 <= r.taken <= 3 * r.size for r in rows) and sum(r.size for r in rows if r.doc_id is None) == 2
    if name == "op4_nn_descent":
        assert {r.query_id for r in rows} == set(range(0, 90, 20)) and all(r.rank <= 20 and r.vec_id != r.query_id for r in rows)
    if name == "op5_minhash_dedup":
        assert {(r.component_id, r.kept) for r in rows if r.doc_id == 1002} == {(0, False)}

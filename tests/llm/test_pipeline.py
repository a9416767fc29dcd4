from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from .test_searches import brute_components


@pytest.fixture(scope="module")
def corpus(spark):
    rng, folder = random.Random(4), tempfile.mkdtemp()
    tongue = {"aa": "abcdefg", "bb": "ghijklm"}
    say = lambda n, a: " ".join("".join(rng.choices(a, k=rng.randint(2, 8))) for _ in range(n))
    bench = [(k, say(12, tongue["aa"])) for k in range(5)]
    docs, labels = [], []
    for i in range(500):
        lang = rng.choice(list(tongue))
        t, good = ". ".join(say(rng.randint(4, 10), tongue[lang]) for _ in range(rng.randint(2, 9))), i % 6 != 0
        if not good:
            t = " ".join(w + "$$$ ###" for w in t.split())
        elif i % 25 == 1:
            t += " " + bench[i % 5][1]
        docs.append((i, t, lang, "src" + str(i % 4)))
        if i % 4:
            labels.append((i, int(good), 0))
    docs += [(1000 + k, docs[5][1] + f" extra{k}"[: k + 2], docs[5][2], "src0") for k in range(10)]
    docs += [(2000, None, "aa", None), (2001, "12 34 56", "bb", "src1"), (2002, docs[7][1], None, "src2"), (2002, docs[7][1], None, "src2")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumns({"n_chars": F.length("text"), "__score": F.lit(1), "__lang": F.lit("x"), "__ambiguous": F.lit(2), "__rank": F.lit(3), "__id": F.lit(4), "__text": F.lit("y"), "__maybe": F.lit(5)}).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, at = docs.columns, tempfile.mkdtemp()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus).write.parquet(f"{at}/{k}")
        after = spark.read.parquet(f"{at}/{k}")
        had, has = docs.collect(), after.collect()
        if k < 4:
            assert after.columns == columns
            assert {r.doc_id for r in has} <= {r.doc_id for r in had}
        gone = {r.doc_id for r in had} - {r.doc_id for r in has}
        if name == names[0]:
            bad = {i for i in range(500) if i % 6 == 0}
            assert len(bad - gone) <= 4 and len({g for g in gone if g < 1000} - bad) <= 8
        elif name == names[1]:
            assert not any(r.text is None or not any(c.isalpha() for c in r.text) for r in has)
            assert len(gone - {2000, 2001}) <= 5
        elif name == names[2]:
            want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in had], 5)}
            assert sorted(r.doc_id for r in has) == sorted(want)
        elif name == names[3]:
            held = {i for i in range(500) if i % 25 == 1 and i % 6}
            assert gone == held & {r.doc_id for r in had}
        else:
            assert len(has) == len(had) and {"doc_id", "taken", "target"} <= set(after.columns)
        docs = after
    assert corpus_pipeline.run(spark, corpus).count() == docs.count()


def test_nothing_to_learn_from_keeps_all(spark, corpus):
    folder = tempfile.mkdtemp()
    docs = spark.read.parquet(f"{corpus}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.quality_stage(spark, docs, folder).count() == docs.count()
    assert corpus_pipeline.language_stage(spark, docs, folder).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        if not os.path.exists(f"{folder}/benchmark.parquet"):
            spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        assert stage(spark, docs.limit(0), folder).count() == 0

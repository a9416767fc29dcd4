from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm import langid, quality, toxicity, urlfilter
from terraloom.llm.sampling import crc_mod, per_class


def words(rng, n, alphabet="etaoinshr"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def toxic(spark):
    rng, rows = random.Random(1), []
    for i in range(700):
        sents = [words(rng, rng.randint(3, 12)) for _ in range(rng.randint(1, 12))]
        bad = i % 3 == 0
        if bad:
            k = rng.randrange(len(sents))
            sents[k] += " " + rng.choice(["vile", "Scum,", "rotten"])
        rows.append((i, ". ".join(sents) + ".", int(bad)))
    rows += [(9001, None, 0), (9002, "", 1), (9003, "...", 0), (9004, "ok. " * 40_000, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int").withColumn("score", F.lit("clash"))


def test_toxicity_learns_words_and_finds_sentences(spark, toxic):
    train = toxic.where("doc_id % 5 <> 0").select(F.col("doc_id").alias("id"), "label")
    model = toxicity.fit(toxic.select("doc_id", "text", "score"), train)
    out = toxicity.score(toxic.select("doc_id", "label", "text"), model).toPandas()
    assert len(out) == 704 and out.score.between(0, 1).all()
    held = out[(out.doc_id % 5 == 0) & (out.doc_id < 9000)]
    assert ((held.score >= 0.5) == (held.label == 1)).mean() > 0.95
    assert out[out.doc_id.isin([9001, 9002, 9003])].score.max() == 0
    text = "Fine day. You are scum today! Élan vital."
    d = spark.createDataFrame([(1, text), (2, "Fine."), (3, None)], "doc_id long, text string")
    (row,) = toxicity.locate(d, model).collect()
    (s,) = row.sentences
    assert row.doc_id == 1 and text[s.start : s.start + s.length] == "You are scum today"


def test_toxicity_without_labels(spark, toxic):
    none = spark.createDataFrame([], "id long, label int")
    model = toxicity.fit(toxic, none)
    assert toxicity.score(toxic.select("doc_id", "text"), model).where("score > 1e-9").count() == 0
    assert toxicity.score(toxic.select("doc_id", "text").limit(0), model).count() == 0


def test_toxicity_sample_is_bounded_by_its_words(spark):
    rows = [(1.0, b"x" * 8 * n, b"", at) for at, n in enumerate([50, 30, 30])] + [(0.0, b"x" * 8 * n, b"", at) for at, n in enumerate([900, 1])] + [(2.0, b"", b"", 7)]
    bags = spark.createDataFrame(rows, "label double, h binary, s binary, place long")
    kept = lambda n: sorted((r.label, r.place) for r in toxicity._within(bags, toxicity.ToxicityParams(max_words=n)).collect())
    assert kept(80) == [(0.0, 0), (1.0, 0), (1.0, 1), (2.0, 7)] and kept(1) == [(0.0, 0), (1.0, 0), (2.0, 7)] and len(kept(901)) == 6


def test_columns_of_a_new_name_are_replaced(spark):
    odd = spark.createDataFrame([(1, "abc", "x", "y", "z", "u")], "doc_id long, text string, Score string, offending string, verdict string, __text string")
    bad = toxicity.ToxicityModel(np.empty(0, np.uint64), np.empty(0), -30.0)
    assert toxicity.score(odd, bad).first().asDict() == {"doc_id": 1, "verdict": "z", "__text": "u", "score": 0.0, "offending": 0}
    none = quality.fit(odd, spark.createDataFrame([], "id long, label int"))
    assert quality.score(odd, none).first().asDict() == {"doc_id": 1, "offending": "y", "verdict": "z", "__text": "u", "score": 0.5}
    unlearnt = langid.fit(odd, spark.createDataFrame([], "id long, label string"))
    assert langid.predict(odd, unlearnt).first().asDict() == {"doc_id": 1, "offending": "y", "verdict": "z", "__text": "u", "lang_pred": "und", "score": 0.0, "ambiguous": False}
    said = urlfilter.judge_urls(odd.withColumn("__url", F.lit("v")), [], url_col="text").first().asDict()
    assert said == {"doc_id": 1, "Score": "x", "offending": "y", "__text": "u", "__url": "v", "host": "", "path": "", "rule": None, "verdict": "allow"}


def test_sentence_scores_make_the_document_score():
    m = toxicity.ToxicityModel(np.sort(toxicity.tx.word_hashes("bad awful")), np.array([3.0, 3.0]), -2.0)
    h, number, first, _ = toxicity.sentences("bad bad day. fine\nawful bad.")
    s = m.sentence_scores(h, number, len(first))
    sig = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(s, [sig(1), sig(-2), sig(4)])
    assert np.isclose(toxicity._doc_score(s), 1 - (1 - sig(1)) * (1 - sig(-2)) * (1 - sig(4)))


@pytest.fixture(scope="module")
def graded(spark):
    rng, rows = random.Random(2), []
    for i in range(800):
        good = i % 5 != 0
        t = ". ".join(words(rng, rng.randint(4, 14)).capitalize() for _ in range(rng.randint(2, 20)))
        if not good:
            t = " ".join(w + rng.choice(["$$$", "###", "!!"]) for w in t.split()) if i % 2 else (t.split()[0] + " ") * 60
        rows.append((i, t, int(good)))
    rows += [(9001, None, 1), (9002, "", 0), (9003, "x" * 300_000, 1), (9004, "\ud83d\ude00", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_quality(spark, graded):
    train = graded.where(crc_mod("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), "label")
    model = quality.fit(graded, train)
    out = quality.score(graded, model).toPandas()
    assert len(out) == 804 and out.score.between(0, 1).all() and not out.score.isna().any()
    held = out[(out.doc_id < 9000)]
    assert ((held.score >= 0.7) == (held.label == 1)).mean() > 0.97
    kept = quality.score(graded, model, name="__s", keep_text=True)
    assert kept.columns == ["doc_id", "text", "label", "__s"]


def test_few_rows_of_a_label_are_calibrated_by_isotonic_regression(spark, graded, monkeypatch):
    seen = []
    real = quality.isotonic
    monkeypatch.setattr(quality, "isotonic", lambda x, y, w: seen.append(len(y)) or real(x, y, w))
    train = graded.where("doc_id < 600 AND (label = 1 OR doc_id % 4 = 0)").select(F.col("doc_id").alias("id"), "label")
    model = quality.fit(graded, train)
    assert train.where("label = 0").count() < 200 and seen == [train.count()]
    assert (np.diff(model.knots) >= 0).all() and (np.diff(model.values) >= 0).all()


def test_quality_with_one_label_or_none(spark, graded):
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "id long, label int")
    assert {r.score for r in quality.score(graded, quality.fit(graded, one)).collect()} == {1.0}
    assert {r.score for r in quality.score(graded, quality.fit(graded, one.limit(0))).collect()} == {0.5}


def test_isotonic_is_the_least_squares_monotone_fit():
    x, y = np.array([1.0, 2, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1])
    knots, values = quality.isotonic(x, y)
    assert (np.diff(values) >= 0).all() and np.allclose(np.interp([1, 3, 4], knots, values), [0, 1 / 3, 1])


def test_isotonic_weights_stand_for_repeated_rows():
    """Whatever the weights, at a cost of the rows alone; equal x are pooled in any order."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 30, 200) / 7, rng.integers(0, 2, 200).astype(float)
    w = rng.integers(1, 9, 200)
    got, want = quality.isotonic(x, y, w.astype(float)), quality.isotonic(np.repeat(x, w), np.repeat(y, w))
    turned = quality.isotonic(x[::-1], y[::-1], w[::-1].astype(float))
    assert all(np.allclose(a, b) for a, b in zip(got + got, want + turned, strict=True))
    knots, values = quality.isotonic(np.array([1.0, 1, 2]), np.array([0.0, 1, 1]), np.array([1.0, 1e9, 1e9]))
    assert np.allclose(knots, [1, 2]) and np.allclose(values, [1, 1], atol=1e-8)


def test_random_features_approximate_the_kernel():
    p = quality.QualityParams(features=4096)
    rng = np.random.default_rng(0)
    m = quality.QualityModel(np.zeros(3), np.ones(3), rng.normal(size=(3, p.features)) / p.bandwidth, rng.uniform(0, 2 * np.pi, p.features), None, None, None)
    a, b = np.array([[0.5, 1, -1]]), np.array([[-1.0, 2, 0]])
    got = (m.lift(a)[:, :-1] @ m.lift(b)[:, :-1].T).item()
    assert abs(got - np.exp(-((a - b) ** 2).sum() / 2 / p.bandwidth**2)) < 0.05


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(3)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijk", "dd": "éèüöß", "ee": "klmno", "ff": "мнопр", "gg": "aeiou"}
    rows = [(i * 10 + k, words(rng, rng.randint(5, 60), a), lang) for i in range(60) for k, (lang, a) in enumerate(letters.items())]
    rows += [(9001, None, "aa"), (9002, "", "aa"), (9003, "12 34 !?", "bb"), (9004, "abcd " * 100_000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_langid(spark, tongues):
    train = tongues.where(crc_mod("doc_id", 3) != 1).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    model = langid.fit(tongues, train)
    out = langid.predict(tongues, model).toPandas().set_index("doc_id")
    assert (out.loc[[9001, 9002, 9003]].lang_pred == "und").all() and (out.loc[[9001, 9002, 9003]].score == 0).all()
    assert out.loc[9004].lang_pred == "aa"
    rest = out[out.index < 9000]
    assert (rest.lang_pred == rest.lang).mean() > 0.98 and out.score.between(0, 1).all()
    code = model.code
    assert all((code[:, j] == 1).any() and (code[:, j] == -1).any() for j in range(code.shape[1]))
    assert min((code[i] != code[j]).sum() for i in range(7) for j in range(i)) >= code.shape[1] / 4


def test_langid_with_no_or_one_language(spark, tongues):
    none = spark.createDataFrame([], "id long, label string")
    assert {r.lang_pred for r in langid.predict(tongues, langid.fit(tongues, none)).collect()} == {"und"}
    with pytest.raises(ValueError, match="more than 3"):
        langid.fit(tongues, tongues.select(F.col("doc_id").alias("id"), F.col("lang").alias("label")), langid.LangIdParams(most_langs=3))
    one = tongues.where("lang = 'bb'").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    assert {r.lang_pred for r in langid.predict(tongues, langid.fit(tongues, one)).collect()} == {"bb", "und"}


def test_an_even_mixture_is_ambiguous():
    p = langid.LangIdParams()
    m = langid.LangIdModel(["a", "b"], np.array([[1], [-1]]), np.zeros((p.bins, 1)), np.zeros(1), np.ones(1), p)
    _, score, flag = m.decode(np.zeros((1, p.bins)))
    assert flag[0] and np.isclose(score[0], 0.5)


def test_samples_are_the_lowest_hashes_of_each_label(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 30 == 0, "few").when(F.col("id") % 3 == 1, "a").otherwise("b").alias("label")).unionAll(spark.sql("SELECT 5L, 'a' UNION ALL SELECT null, 'a' UNION ALL SELECT 7L, null"))
    hashed = df.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("id")).collect()
    for bound in (1, 50, 700, 5000):
        want = []
        for label in ("few", "a", "b"):
            want += [(r.id, label) for r in sorted((r for r in hashed if r.label == label), key=lambda r: r.h)[:bound]]
        assert sorted(map(tuple, per_class(df.repartition(7), "id", "label", bound).collect())) == sorted(want)


def test_quality_equals_a_direct_fit(spark, graded):
    """The model from partition sums is the ridge and the pooled fit that numpy makes of all rows at once."""
    train = graded.where("label IS NOT NULL").select(F.col("doc_id").alias("id"), "label")
    p = quality.QualityParams()
    m = quality.fit(graded, train, p)
    rows = graded.where("label IS NOT NULL").select("text", "label", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(p.seed)), F.lit(p.folds)).alias("fold")).collect()
    x, y, fold = np.array([quality.statistics(r.text) for r in rows]), np.array([r.label for r in rows], float), np.array([r.fold for r in rows])
    assert np.allclose(m.mean, x.mean(axis=0)) and np.allclose(m.scale, np.maximum(x.std(axis=0), 1e-6))
    z = np.hstack([np.cos(np.clip((x - m.mean) / m.scale, -6, 6) @ m.waves + m.phase) * np.sqrt(2 / p.features), np.ones((len(x), 1))])

    def ridge(of):
        return np.linalg.solve(z[of].T @ z[of] + p.ridge * np.eye(z.shape[1]), z[of].T @ (2 * y[of] - 1))

    assert np.allclose(m.weights, ridge(fold >= 0), atol=1e-6)
    raw = np.array([z[i] @ ridge(fold != fold[i]) for i in range(0, len(x), 10)])
    knots, values = quality.isotonic(np.concatenate([z[fold == k] @ ridge(fold != k) for k in range(p.folds)]), np.concatenate([y[fold == k] for k in range(p.folds)]))
    assert np.allclose(np.interp(raw, m.knots, m.values), np.interp(raw, knots, values), atol=1e-3)
    odd = train.unionAll(spark.sql("SELECT 9003L, 7"))
    assert np.allclose(quality.fit(graded, odd.where("id <> 9003 OR label = 7")).weights, quality.fit(graded, train.where("id <> 9003")).weights, atol=1e-6)


def test_langid_equals_a_direct_fit(spark, tongues):
    """Codeword by codeword, bit by bit, document by document, in plain loops."""
    train = tongues.where("lang IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    m = langid.fit(tongues, train)
    docs = [r for r in tongues.collect() if r.text and any(c.isalpha() for c in r.text)]
    mean = {k: np.mean([langid.grams(r.text, m.p.bins) for r in docs if r.lang == k], axis=0) for k in m.langs}
    weights, bias = np.zeros((m.p.bins, m.code.shape[1])), np.zeros(m.code.shape[1])
    for j in range(m.code.shape[1]):
        one, none = ([mean[k] for k, c in zip(m.langs, m.code[:, j], strict=True) if c == s] for s in (1, -1))
        w = np.log((np.mean(one, axis=0) + 0.05 / m.p.bins) / (np.mean(none, axis=0) + 0.05 / m.p.bins))
        hi, lo = min(v @ w for v in one), max(v @ w for v in none)
        weights[:, j], bias[j] = w * 6 / abs(hi - lo), -(hi + lo) / 2 * 6 / abs(hi - lo)
    assert np.allclose(m.weights, weights) and np.allclose(m.bias, bias)
    said = {r.doc_id: r for r in langid.predict(tongues, m).collect()}
    for r in docs[::7]:
        margin = langid.grams(r.text, m.p.bins) @ weights + bias
        loss = [sum(p * np.log1p(np.exp(-c * x)) for p, c, x in zip(m.power, word, margin, strict=True)) / m.power.sum() for word in m.code]
        assert said[r.doc_id].lang_pred == m.langs[int(np.argmin(loss))]
        two = sorted(loss)[:2]
        assert said[r.doc_id].ambiguous == (two[1] - two[0] < m.p.gap) and np.isclose(said[r.doc_id].score, 1 / sum(np.exp(-4 * (x - two[0])) for x in loss))


def test_toxicity_scores_equal_a_direct_noisy_or(spark, toxic):
    """Sentences and words in plain Python, by the words the model holds; and the fit is a minimum of its own loss."""
    train = toxic.select(F.col("doc_id").alias("id"), "label").unionAll(spark.sql("SELECT 9001L, 5"))
    m = toxicity.fit(toxic.select("doc_id", "text"), train)
    held = dict(zip(m.words.tolist(), m.weights.tolist(), strict=True))
    for r in toxicity.score(toxic.select("doc_id", "text", F.col("text").alias("copy")), m).where("doc_id < 60").collect():
        none = 1.0
        for sentence in re.split(r"[.!?\n]", r.copy):
            words_ = {int(h) for w in re.findall(r"[a-z0-9'\u0080-\U0010ffff]+", sentence.lower()) for h in toxicity.tx.word_hashes(w)}
            if words_:
                none *= 1 - 1 / (1 + math.exp(-m.bias - sum(held.get(w, 0.0) for w in words_)))
        assert math.isclose(r.score, 1 - none, abs_tol=1e-9)
    words_ = {w: float(m.weights[m.words == toxicity.tx.word_hashes(w)[0]].sum()) for w in ("vile", "scum", "rotten")}
    assert min(words_.values()) > 3 and sum(v > 1 for v in held.values()) <= 6

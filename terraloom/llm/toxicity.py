"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores ``s = sigmoid(bias + sum of the weights
of its distinct words)``, and a document scores ``1 - prod(1 - s)`` (noisy-or). Bias and
weights are trained by gradient descent on document labels alone; the sentence scores then
tell which sentences offend.

Fitting reads at most ``max_rows`` labelled documents of each label (lowest id hashes, and no
more than hold ``max_words`` words together, so that the driver's part is bounded), in full,
and keeps every word of ``min_docs`` of them or more whose document frequencies differ
between the labels by ``least_z`` standard errors; scoring reads every text in full. Null, empty and word-less texts have no sentence
and score 0. Without labels of both kinds every document scores 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from . import text as tx
from .runtime import Scratch, free_name, kept_columns
from .sampling import per_class, with_text


@dataclass(frozen=True)
class ToxicityParams:
    max_rows: int = 4000  # labelled documents of each label
    max_words: int = 8_000_000  # of these documents together, of each label, beyond the first document
    least_z: float = 1.4  # by which a learnt word's document frequencies differ between the labels; three documents of one label reach it
    min_docs: int = 3  # documents that a learnt word is in, at least
    steps: int = 300
    penalty: float = 0.1  # of a weight's absolute value, in standard deviations of its derivative's noise
    offends: float = 0.5  # a sentence of this score or more is offending


#: Everything but letters, digits, the apostrophe and bytes of non-ASCII characters ends a word.
GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), 39]] = False
GAP[128:] = False
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?\n"]] = True


def sentences(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, sentence number of each word, first byte and end byte of each sentence's words)."""
    h, start, end = tx.tokens(text, GAP)
    stops = np.flatnonzero(STOP[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)])
    number = np.searchsorted(stops, start)
    fresh = np.append(True, number[1:] != number[:-1]) if len(h) else np.zeros(0, bool)  # numbers ascend
    first, number = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    last = np.append(first[1:], len(h)) - 1
    return h, number, start[first], end[last] if len(h) else start[first]


@dataclass
class ToxicityModel:
    words: np.ndarray  # ascending hashes
    weights: np.ndarray
    bias: float

    def sentence_scores(self, h: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
        if not n or not len(self.words):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == h)
        if not len(hit):
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        pair = tx.distinct(number[hit].astype(np.int64) * len(self.words) + at[hit])  # a word counts once in a sentence
        z = self.bias + np.bincount(pair // len(self.words), weights=self.weights[pair % len(self.words)], minlength=n)
        return 1 / (1 + np.exp(-z))


def _doc_score(s: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(s, 1 - 1e-12)).sum()))


def _to_bags(batches):
    schema = pa.schema([("label", pa.float64()), ("h", pa.binary()), ("s", pa.binary()), ("place", pa.int64())])
    for batch in batches:
        labels, hs, ss = batch.column(0), [], []
        for t in batch.column(2):
            h, number, _, _ = sentences(t.as_py())
            hs.append(h.tobytes())
            ss.append(number.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([labels, pa.array(hs, pa.binary()), pa.array(ss, pa.binary()), batch.column(1)], schema=schema)


def _within(bags: DataFrame, p: ToxicityParams) -> DataFrame:
    """The bags of each label in order of their ids' hashes, as far as they hold max_words words; at least one."""
    sizes = bags.select("label", "place", (F.octet_length("h") / 8).cast("long").alias("n")).collect()  # of the sample's rows
    last: dict[float, int] = {}
    held: dict[float, int] = {}
    for r in sorted(sizes, key=lambda r: r.place):
        held[r.label] = held.get(r.label, 0) + r.n
        if r.label not in last or held[r.label] <= p.max_words:
            last[r.label] = r.place
    if all(n <= p.max_words for n in held.values()):
        return bags
    return bags.where(reduce(or_, [(F.col("label") == k) & (F.col("place") <= v) for k, v in last.items()]))


def fit(docs: DataFrame, labelled: DataFrame, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """labelled: (id, label 0/1), the rows that may be learnt from; other labels are left out."""
    labelled = labelled.where("label IN (0, 1)")
    tmp = Scratch(docs.sparkSession, "toxicity")
    sample = tmp.write(per_class(labelled, "id", "label", p.max_rows), "sample")
    texts = with_text(sample, docs, 2 * p.max_rows).select(F.col("label").cast("double").alias("label"), F.xxhash64("id").alias("place"), "text")
    bags = _within(tmp.write(texts.mapInArrow(_to_bags, "label double, h binary, s binary, place long").repartition(16), "bags"), p)
    n = {r[0]: r[1] for r in bags.groupBy("label").count().collect()}
    if len(n) < 2:
        tmp.drop("sample", "bags")
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), -30.0)
    totals = {float(r[0]): r[1] for r in labelled.groupBy("label").count().collect()}

    # Document frequencies of the sample's words, by label; Spark keeps the telling ones.
    def words(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                u = tx.distinct(np.frombuffer(batch.column(1)[i].as_py(), np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(np.full(len(u), batch.column(0)[i].as_py()), pa.float64())], names=["w", "y"])

    df = bags.mapInArrow(words, "w long, y double").groupBy("w").agg(F.sum("y").alias("d1"), F.sum(1 - F.col("y")).alias("d0")).where(F.col("d1") + F.col("d0") >= p.min_docs)
    p1, p0 = (F.col("d1") + 0.5) / (n[1.0] + 1), (F.col("d0") + 0.5) / (n[0.0] + 1)
    z = (p1 - p0) / F.sqrt(p1 / n[1.0] + p0 / n[0.0])
    top = df.where(F.abs(z) >= p.least_z).select("w").collect()
    vocabulary = np.sort(np.array([r.w for r in top], dtype=np.int64).view(np.uint64))

    def narrow(batches):
        for batch in batches:
            docs_, pairs = [], []
            for i in range(batch.num_rows):
                h, s = np.frombuffer(batch.column(1)[i].as_py(), np.uint64), np.frombuffer(batch.column(2)[i].as_py(), np.int32)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                hit = vocabulary[at] == h
                pairs.append(tx.distinct(s[hit].astype(np.int64) * len(vocabulary) + at[hit]).tobytes())
                docs_.append(int(s[-1]) + 1 if len(s) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(docs_, pa.int32()), pa.array(pairs, pa.binary())], names=["label", "n", "pairs"])

    rows = bags.mapInArrow(narrow, "label double, n int, pairs binary").collect()
    tmp.drop("sample", "bags")
    rows = [r for r in rows if r.n]
    if not len(vocabulary) or not rows:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), -30.0)
    y = np.array([r.label for r in rows])
    size = np.array([r.n for r in rows])
    offset = np.concatenate([[0], np.cumsum(size)])
    pairs = [np.frombuffer(r.pairs, np.int64) for r in rows]
    sent = np.concatenate([q // len(vocabulary) + o for q, o in zip(pairs, offset[:-1], strict=True)])
    word = np.concatenate([q % len(vocabulary) for q in pairs])
    weight = np.where(y == 1, totals[1.0] / n[1.0], totals[0.0] / n[0.0])
    weights, bias = _descend(y, weight / weight.mean(), offset, sent, word, len(vocabulary), p)
    used = weights != 0
    return ToxicityModel(vocabulary[used], weights[used], bias)


def _descend(y, weight, offset, sent, word, n_words: int, p: ToxicityParams) -> tuple[np.ndarray, float]:
    """Accelerated proximal descent on the noisy-or likelihood of the document labels.

    A word's penalty is ``penalty`` times the noise that its derivative has if it tells
    nothing, so that words in few documents are neither favoured nor shut out. After two
    thirds of the steps the words left are refitted without it, against shrunken weights.
    """
    n_sent, n = int(offset[-1]), len(y)
    doc = np.repeat(np.arange(n), np.diff(offset))
    first = np.unique(word.astype(np.int64) * n + doc[sent])  # a word counts once in a document
    share = np.bincount(first // n, weights=weight[first % n], minlength=n_words) / n
    base = float((weight * y).sum() / weight.sum())
    noise = np.sqrt(share * base * (1 - base) / n)
    crowd = np.bincount(sent, minlength=n_sent)[sent].mean() if len(sent) else 1.0
    curve = np.append(0.25 * np.maximum(share, 1 / n) * max(1.0, crowd), 1.0)

    def loss(v):
        z = np.clip(v[-1] + np.bincount(sent, weights=v[word], minlength=n_sent), -30, 30)
        s = 1 / (1 + np.exp(-z))
        none = np.exp(np.bincount(doc, weights=-np.logaddexp(0, z), minlength=n))  # P(no sentence offends)
        pos = np.maximum(1 - none, 1e-9)
        value = float((weight * np.where(y == 1, -np.log(pos), -np.log(np.maximum(none, 1e-300)))).sum() / n)
        # by a sentence's logit: s if the label is 0, -s * none / (1 - none) if it is 1
        g = (weight * np.where(y == 1, -none / pos, 1.0))[doc] * s / n
        return value, np.append(np.bincount(word, weights=g[sent], minlength=n_words), g.sum())

    v = np.append(np.zeros(n_words), np.log(max(base, 1e-4)) - np.log(max(1.0, n_sent / n)))
    ahead, t, rate, last = v.copy(), 1.0, 1.0, np.inf
    free = np.ones(n_words, bool)
    for step in range(p.steps):
        refit = step >= p.steps * 2 // 3
        if step == p.steps * 2 // 3:
            free, last = v[:-1] != 0, np.inf
        value, grad = loss(ahead)
        if refit:
            grad = grad + np.append(1e-4 * ahead[:-1], 0.0)
        move = ahead - rate * grad / curve
        shrink = 0.0 if refit else rate * p.penalty * noise / curve[:-1]
        new = np.append(np.where(free, np.sign(move[:-1]) * np.maximum(np.abs(move[:-1]) - shrink, 0.0), 0.0), move[-1])
        if value > last * 1.001 + 1e-9:  # too fast: start again from here, slower
            rate, t, ahead, last = rate * 0.7, 1.0, v.copy(), np.inf
            continue
        last, t_new = value, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, v, t = new + (t - 1) / t_new * (new - v), new, t_new
    return v[:-1], float(v[-1])


def score(docs: DataFrame, model: ToxicityModel, p: ToxicityParams = ToxicityParams(), text_col: str = "text") -> DataFrame:
    """docs' columns without the text, with ``score`` and ``offending``, the number of offending sentences; columns that docs has of these names are replaced."""
    kept = kept_columns(docs, text_col, ("score", "offending"))

    def run(batches):
        for batch in batches:
            total, bad = [], []
            for t in batch.column(len(kept)):
                h, number, first, _ = sentences(t.as_py())
                s = model.sentence_scores(h, number, len(first))
                total.append(_doc_score(s))
                bad.append(int((s >= p.offends).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(total, pa.float64()), pa.array(bad, pa.int32())], names=[*kept, "score", "offending"])

    rest = docs.select(*kept)
    return docs.select(*kept, F.col(text_col).alias(free_name(docs, "__text"))).mapInArrow(run, StructType([*rest.schema.fields, StructField("score", DoubleType()), StructField("offending", IntegerType())]))


def locate(docs: DataFrame, model: ToxicityModel, p: ToxicityParams = ToxicityParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentences: array of (start, length, score)) of the documents with offending sentences; start and length in code points."""
    span = ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("score", DoubleType())]))

    def run(batches):
        for batch in batches:
            ids, spans = [], []
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                h, number, first, end = sentences(t.as_py())
                s = model.sentence_scores(h, number, len(first))
                hit = np.flatnonzero(s >= p.offends)
                if len(hit):
                    heads = np.frombuffer(t.as_py().encode("utf-8", "surrogatepass"), np.uint8) & 0xC0 != 0x80
                    code = np.concatenate([[0], np.cumsum(heads)])
                    ids.append(i.as_py())
                    spans.append([{"start": int(code[first[k]]), "length": int(code[end[k]] - code[first[k]]), "score": float(s[k])} for k in hit])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())])))], names=[id_col, "sentences"])

    return docs.select(id_col, text_col).mapInArrow(run, StructType([docs.select(id_col).schema.fields[0], StructField("sentences", span)]))

"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Every text becomes a vector of surface statistics (lengths, character classes, repetition).
A Gaussian kernel over the standardised statistics is approximated by random cosine
features; each partition sums its part of the normal equations, the sums of a bounded
number of partitions meet on the driver, and the ridge solution's raw scores are made
probabilities by isotonic regression, whatever the number of rows: each quarter of the sampled
rows is scored by a ridge that did not see it, and all of them calibrate the ridge of all rows.

Fitting uses at most ``max_rows`` labelled rows of each label (lowest id hashes); scoring
reads every text in full. Null and empty texts score like a text without words. Without
labelled rows the score is 0.5 throughout; with labels of one kind it is that label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import text as tx
from .runtime import Scratch, free_name, kept_columns
from .sampling import per_class, with_text


@dataclass(frozen=True)
class QualityParams:
    max_rows: int = 8000  # labelled rows of each label
    features: int = 256  # random cosine features
    bandwidth: float = 4.0  # of the Gaussian kernel, in standard deviations
    ridge: float = 1e-2
    parts: int = 8  # partitions that sum normal equations
    folds: int = 4  # each is calibrated by the ridge of the others
    seed: int = 11


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.arange(256) >= 128
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?'\"-()"]] = True
_ODD = np.zeros(256, bool)
_ODD[[c for c in range(33, 127) if not (_UPPER[c] or _LOWER[c] or _DIGIT[c] or _STOP[c])]] = True


def statistics(text: str | None) -> np.ndarray:
    """Surface statistics of the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(data))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = count / n
    h, start, end = tx.tokens(text)
    w = max(1, len(h))
    long = end - start
    letters = max(1, count[_UPPER].sum() + count[_LOWER].sum())
    order = np.sort(h)
    edge = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1], [True]])) if len(h) else np.zeros(2, int)
    times = np.diff(edge)
    lines = data.split(b"\n")
    filled = [x for x in lines if x.strip()]
    p = share[share > 0]
    last = np.frombuffer(data, np.uint8)[end - 1] if len(h) else np.zeros(0, np.uint8)
    return np.array([
        np.log1p(len(data)), np.log1p(len(h)), long.mean() if len(h) else 0.0, (long <= 3).sum() / w, (long >= 14).sum() / w,
        count[_UPPER].sum() / letters, share[_DIGIT].sum(), share[_ODD].sum(), share[_STOP].sum(), share[_HIGH].sum(), share[tx.IS_SPACE].sum(),
        len(times) / w, times.max() / w, (h[1:] == h[:-1]).sum() / w, np.log1p(len(filled)), 1.0 - len(set(filled)) / max(1, len(filled)),
        np.log1p(len(data) / max(1, len(lines))), -(p * np.log2(p)).sum() if len(data) else 0.0, (_ODD[last]).sum() / w, count[ord("|")] / w, count[ord("!")] / w,
    ])


N_STATS = 21


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, ascending
    values: np.ndarray  # calibrated scores at the knots, ascending
    constant: float | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.waves + self.phase
        return np.hstack([np.cos(z) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.lift(x) @ self.weights, self.knots, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x, rows weighted, equal x pooled first; (knots, values), both ascending."""
    weight = np.ones(len(x)) if weight is None else weight
    at, of = np.unique(x, return_inverse=True)
    total, size = np.bincount(of, weights=weight * y, minlength=len(at)), np.bincount(of, weights=weight, minlength=len(at))
    blocks: list[list[float]] = []  # sum, size, first x, last x
    for v, s, n in zip(at, total, size, strict=True):
        blocks.append([s, n, v, v])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = hi
    knots = np.array([v for s, n, lo, hi in blocks for v in ((lo, hi) if hi > lo else (lo,))])
    values = np.array([s / n for s, n, lo, hi in blocks for _ in ((lo, hi) if hi > lo else (lo,))])
    return knots, values


def _to_statistics(batches):
    schema = pa.schema([("label", pa.float64()), ("fold", pa.int64()), ("x", pa.list_(pa.float64()))])
    for batch in batches:
        rows = [statistics(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], schema=schema)


def fit(docs: DataFrame, labelled: DataFrame, p: QualityParams = QualityParams()) -> QualityModel:
    """labelled: (id, label 0/1), the rows that may be learnt from; other labels are left out."""
    labelled = labelled.where("label IN (0, 1)")
    tmp = Scratch(docs.sparkSession, "quality")
    sample = tmp.write(per_class(labelled, "id", "label", p.max_rows), "sample")
    texts = with_text(sample, docs, 2 * p.max_rows)
    rows = texts.select(F.col("label").cast("double").alias("label"), F.pmod(F.xxhash64("id", F.lit(p.seed)), F.lit(p.folds)).alias("fold"), "text")
    stats = tmp.write(rows.mapInArrow(_to_statistics, "label double, fold long, x array<double>").repartition(p.parts), "statistics")
    kinds = {r[0]: r[1] for r in stats.groupBy("label").count().collect()}
    rng = np.random.default_rng(p.seed)
    waves, phase = rng.normal(size=(N_STATS, p.features)) / p.bandwidth, rng.uniform(0, 2 * np.pi, p.features)
    model = QualityModel(np.zeros(N_STATS), np.ones(N_STATS), waves, phase, np.zeros(p.features + 1), np.zeros(1), np.zeros(1))
    if len(kinds) < 2:
        model.constant = next(iter(kinds), 0.5)
        tmp.drop("sample", "statistics")
        return model
    moments = stats.select(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(N_STATS)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(N_STATS)]).first()
    model.mean = np.array(moments[:N_STATS])
    model.scale = np.maximum(np.array(moments[N_STATS:]), 1e-6)
    # Rows of the two labels count as often as they occur among all labelled rows.
    totals = {float(r[0]): r[1] for r in labelled.groupBy("label").count().collect()}
    weight = {k: totals[k] / n for k, n in kinds.items()}
    weight = {k: w * sum(kinds.values()) / sum(totals[k] for k in kinds) for k, w in weight.items()}

    def sums(batches):
        a, b = np.zeros((p.features + 1, p.features + 1)), np.zeros(p.features + 1)
        for batch in batches:
            if batch.num_rows:
                y = batch.column(0).to_numpy(zero_copy_only=False)
                z = model.lift(np.array(batch.column(1).to_pylist()))
                v = np.array([weight[k] for k in y])
                a += (z * v[:, None]).T @ z
                b += z.T @ (v * (2 * y - 1))
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    none = np.zeros((p.features + 1, p.features + 1)), np.zeros(p.features + 1)
    a, b = (dict.fromkeys(range(p.folds), v) for v in none)
    for k in range(p.folds):
        for r in stats.where(F.col("fold") == k).select("label", "x").mapInArrow(sums, "a binary, b binary").collect():
            a[k] = a[k] + np.frombuffer(r.a).reshape(p.features + 1, -1)
            b[k] = b[k] + np.frombuffer(r.b)

    def solved(a, b):
        return np.linalg.solve(a + p.ridge * np.eye(len(b)), b)

    model.weights = solved(sum(a.values()), sum(b.values()))
    # Each quarter is scored by the ridge of the three others, so that all rows can calibrate.
    raw, y = [], []
    for k in range(p.folds):
        part = stats.where(F.col("fold") == k).select("label", "x").toPandas()
        if len(part):
            rest_a, rest_b = (sum(v for j, v in sums_of.items() if j != k) for sums_of in (a, b))
            raw.append(model.lift(np.array(part.x.tolist())) @ solved(rest_a, rest_b))
            y.append(part.label.to_numpy())
    raw, y = np.concatenate(raw), np.concatenate(y)
    model.knots, model.values = isotonic(raw, y, np.array([weight[k] for k in y]))
    tmp.drop("sample", "statistics")
    return model


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score", keep_text: bool = False) -> DataFrame:
    """docs' columns (without the text unless keep_text) and the score of each whole text, a new column called name; one that docs has of that name is replaced."""
    kept = kept_columns(docs, None if keep_text else text_col, (name,))

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(len(kept))]).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(model.score(x), pa.float64())], names=[*kept, name])

    rest = docs.select(*kept)
    schema = StructType([*rest.schema.fields, StructField(name, DoubleType())])
    return docs.select(*kept, F.col(text_col).alias(free_name(docs, "__text"))).mapInArrow(run, schema)

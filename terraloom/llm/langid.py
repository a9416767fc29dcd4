"""Language identification by error-correcting output codes.

Each learnt language gets a binary codeword. For every bit a binary n-gram classifier
(log-odds of hashed byte 2- and 3-grams between the languages whose bit is 1 and those
whose bit is 0) gives a margin; decoding picks the codeword with the smallest sum of
logistic losses, each bit weighted by how well it separates training documents that it was not
learnt from (two halves, either by the classifiers of the other). If the
two best codewords are closer than ``gap`` the text is flagged as ambiguous.

Fitting uses at most ``max_rows`` labelled documents of each language (lowest id hashes) in
full; their n-gram counts are summed in Spark. Prediction reads every text in full. Text
that is null or has no letter is ``und`` with score 0, and so is all if nothing was learnt.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import text as tx
from .runtime import Scratch, free_name, kept_columns
from .sampling import per_class, with_text

UND = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LangIdParams:
    max_rows: int = 500  # documents of each language
    bins: int = 8192  # of hashed n-grams
    most_langs: int = 1000  # labels that can be learnt; the driver holds a vector of bins for each half of each
    gap: float = 0.02  # mean loss per bit between the best two codewords
    seed: int = 7


def grams(text: str | None, bins: int) -> np.ndarray:
    """Shares of hashed byte 2- and 3-grams over the whole text, A-Z lower-cased, each white space as one kind."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(tx._LOWER)
    total = np.zeros(bins)
    for at in range(0, len(data), tx._PIECE):
        b = np.frombuffer(data[at : at + tx._PIECE + 2], np.uint8)
        b = np.where(tx.IS_SPACE[b], 32, b).astype(np.uint32)
        if len(b) < 2:
            continue
        two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0x27D4EB2F) + b[2:] * np.uint32(0xC2B2AE3D)
        lead = min(len(two), tx._PIECE)
        for x in (two[:lead], three[:lead]):
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            total += np.bincount((x ^ (x >> np.uint32(12))) % np.uint32(bins), minlength=bins)
    return total / max(1.0, total.sum())


def codewords(n: int, seed: int) -> np.ndarray:
    """n codewords of +1 and -1, rows; every bit splits the languages, and no two bits are equal or opposite."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:  # all splits there are
        return np.array([[1 if k == 0 or not (m >> (k - 1)) & 1 else -1 for m in range(1, 1 << (n - 1))] for k in range(n)])
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(200):  # random codes; keep the one whose closest pair is farthest apart
        code = np.where(rng.random((n, bits)) < 0.5, 1, -1)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        worst = max(((code @ code.T) - np.diag(np.full(n, 10**6))).max(), -(10**6)) - code.shape[1]
        if best is None or worst < best[0]:
            best = (worst, code)
    return best[1]


@dataclass
class LangIdModel:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bins x bits
    bias: np.ndarray
    power: np.ndarray  # of each bit in decoding
    p: LangIdParams

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        return (np.logaddexp(0, -self.code[None, :, :] * margin[:, None, :]) * self.power).sum(axis=2) / max(1e-9, self.power.sum())

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) of each row of gram shares."""
        if len(self.langs) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        loss = self.losses(x)
        best = loss.argmin(axis=1)
        two = np.partition(loss, 1, axis=1)
        odds = np.exp(-4 * (loss - two[:, :1]))
        return best, 1 / odds.sum(axis=1), two[:, 1] - two[:, 0] < self.p.gap


def _bit_classifiers(share: np.ndarray, code: np.ndarray, p: LangIdParams) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the classifier of each bit, from each language's mean shares of n-grams."""
    floor = 0.05 / p.bins
    weights = np.zeros((p.bins, code.shape[1]))
    bias = np.zeros(code.shape[1])
    for j in range(code.shape[1]):
        a, b = share[code[:, j] > 0].mean(axis=0), share[code[:, j] < 0].mean(axis=0)
        weights[:, j] = np.log((a + floor) / (b + floor))
    # Scale and centre each bit so that the languages' means lie at -3 and +3 or beyond.
    margin = share @ weights
    for j in range(code.shape[1]):
        hi, lo = margin[code[:, j] > 0, j].min(), margin[code[:, j] < 0, j].max()
        scale = 6 / max(1e-6, abs(hi - lo))
        weights[:, j] *= scale
        bias[j] = -(hi + lo) / 2 * scale
    return weights, bias


def fit(docs: DataFrame, labelled: DataFrame, p: LangIdParams = LangIdParams()) -> LangIdModel:
    """labelled: (id, label), the rows that may be learnt from; null labels are left out. Raises if there are more labels than most_langs."""
    if labelled.select("label").distinct().limit(p.most_langs + 2).count() > p.most_langs + 1:  # one of them may be null
        raise ValueError(f"more than {p.most_langs} languages")
    tmp = Scratch(docs.sparkSession, "langid")
    sample = tmp.write(per_class(labelled, "id", "label", p.max_rows), "sample")
    texts = with_text(sample, docs, sample.count()).select("id", "label", "text").repartition(16, "id")

    half = F.pmod(F.xxhash64("id", F.lit(p.seed)), F.lit(2))
    texts = texts.select(half.alias("half"), "label", "text")

    def sums(batches):
        total: dict[tuple, list] = {}
        for batch in batches:
            for k, lang, t in zip(*batch.columns, strict=True):
                if t.is_valid and _LETTER.search(t.as_py()):
                    s = total.setdefault((lang.as_py(), k.as_py()), [0, np.zeros(p.bins)])
                    s[0] += 1
                    s[1] += grams(t.as_py(), p.bins)
        rows = [{"lang": k[0], "half": k[1], "n": n, "s": s.tobytes()} for k, (n, s) in total.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("lang", pa.string()), ("half", pa.int64()), ("n", pa.int64()), ("s", pa.binary())]))

    total: dict[tuple, list] = {}
    for r in texts.mapInArrow(sums, "lang string, half long, n long, s binary").toLocalIterator():
        t = total.setdefault((r.lang, r.half), [0, np.zeros(p.bins)])
        t[0] += r.n
        t[1] += np.frombuffer(r.s)
    langs = sorted({k for k, _ in total})
    if not langs:
        tmp.drop("sample")
        return LangIdModel([], np.ones((0, 0)), np.zeros((p.bins, 0)), np.zeros(0), np.zeros(0), p)
    code = codewords(len(langs), p.seed)

    def shares(halves) -> np.ndarray:
        out = []
        for k in langs:
            t = [total[k, h] for h in halves if (k, h) in total] or [total[k, h] for h in (0, 1) if (k, h) in total]
            out.append(sum(s for _, s in t) / sum(n for n, _ in t))
        return np.stack(out)

    model = LangIdModel(langs, code, *_bit_classifiers(shares((0, 1)), code, p), np.ones(code.shape[1]), p)
    if code.shape[1]:
        index = {k: i for i, k in enumerate(langs)}
        other = [_bit_classifiers(shares((1 - h,)), code, p) for h in (0, 1)]

        def right(batches):
            ok, n = np.zeros(code.shape[1]), 0
            for batch in batches:
                for h, lang, t in zip(*batch.columns, strict=True):
                    if lang.as_py() in index and t.is_valid:
                        weights, bias = other[h.as_py()]
                        ok += (grams(t.as_py(), p.bins) @ weights + bias) * code[index[lang.as_py()]] > 0
                        n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([ok.tolist()], pa.list_(pa.float64()))], names=["n", "ok"])

        parts = texts.mapInArrow(right, "n long, ok array<double>").collect()
        accuracy = np.clip((sum(np.array(r.ok) for r in parts) + 1) / (sum(r.n for r in parts) + 2), 0.51, 0.999)
        model.power = np.log(accuracy / (1 - accuracy))
    tmp.drop("sample")
    return model


def predict(docs: DataFrame, model: LangIdModel, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"), keep_text: bool = False) -> DataFrame:
    """docs' columns (without the text unless keep_text), the predicted language, its score and the flag; columns that docs has of these names are replaced."""
    kept = kept_columns(docs, None if keep_text else text_col, names)

    def run(batches):
        for batch in batches:
            col, n = batch.column(len(kept)), batch.num_rows
            lang, sc, amb = [UND] * n, np.zeros(n), np.zeros(n, bool)
            for at in range(0, n, 512):
                rows = [i for i in range(at, min(n, at + 512)) if model.langs and col[i].is_valid and _LETTER.search(col[i].as_py())]
                if rows:
                    k, s, flag = model.decode(np.stack([grams(col[i].as_py(), model.p.bins) for i in rows]))
                    sc[rows], amb[rows] = s, flag
                    for i, x in zip(rows, k, strict=True):
                        lang[i] = model.langs[x]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(lang, pa.string()), pa.array(sc, pa.float64()), pa.array(amb, pa.bool_())], names=[*kept, *names])

    fields = [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType()), strict=True)]
    return docs.select(*kept, F.col(text_col).alias(free_name(docs, "__text"))).mapInArrow(run, StructType([*docs.select(*kept).schema.fields, *fields]))

"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training rows. Weights are learned from a bounded sample, stratified by language,
by follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them zero; then one temperature is
fitted on sampled rows that the learner hasn't seen. Scoring is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import forget, materialise
from cdclake.llm.ngrams import bucket_counts

SIZES, BITS = (1, 2, 3), 15
#: The learner's sample: about so many rows of each language, and of all languages as many as have so many bytes of
#: features (the bound holds the driver's memory; four languages of common texts take 20 MB). Every language in the
#: training rows is learned.
SAMPLE_EACH, SAMPLE_BYTES = 1000, 256 << 20
#: FTRL: learning rate, its offset, L1, L2, passes over the sample; one row in CALIBRATE serves for the temperature.
ALPHA, BETA, L1, L2, PASSES, CALIBRATE = 0.5, 1.0, 0.02, 0.01, 3, 5
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray  # by bucket
    weights: np.ndarray  # bucket x language, mostly zero
    bias: np.ndarray
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return tfidf(text, self.idf)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*self.vector(text)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def has_letter(text: str | None) -> bool:
    """Whether some character is of Unicode's category L; numbers such as ½ and ² are not."""
    return any(map(str.isalpha, text or ""))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = bucket_counts(text, SIZES, BITS)
    x = (1 + np.log(n)) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal with elastic net; the bias isn't penalised."""
    d = 1 << BITS
    z, n = np.zeros((d + 1, classes)), np.zeros((d + 1, classes))
    l1 = np.full((d + 1, 1), L1)
    l1[d] = 0

    def weights(at: np.ndarray) -> np.ndarray:
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1[at], 0, -(zz - np.sign(zz) * l1[at]) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, d), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(d + 1))
    return w[:d], w[d]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood, by golden section over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, ratio = np.log(0.05), np.log(5.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(train: DataFrame, text_col: str, lang_col: str, key: Column) -> LanguageModel:
    """The model of rows with text and language; key: decides who is in the sample, the same in each run.

    Rows without text or language don't teach; an empty text counts as one of its language. Rows that repeat each
    count, and share their draw if they share the key (rows with a null key are one draw). Without any row to learn
    from the model knows no language. A text of any length is one vector of 2**BITS numbers at most. Other columns
    are not read.
    """
    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 30)).alias("draw"))
    rows = rows.where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    if not sizes:
        return LanguageModel([], np.ones(1 << BITS), np.zeros((1 << BITS, 1)), np.zeros(1), 1.0)
    languages = sorted(r["lang"] for r in sizes)
    place = {lang: k for k, lang in enumerate(languages)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                found[bucket_counts(text, SIZES, BITS)[0]] += 1
                number += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], number), pa.int64())], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # 2**BITS + 1 rows at most
    by = dict(zip(counted["bucket"], counted["n"], strict=True))
    total = by.pop(-1)
    df = np.zeros(1 << BITS)
    df[list(by)] = list(by.values())
    idf = np.log((1 + total) / (1 + df)) + 1

    limits = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(int((1 << 30) * min(1.0, SAMPLE_EACH / r["count"]))))])
    sample = rows.where(F.col("draw") < limits[F.col("lang")])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 500):
                b = big.slice(k, 500)
                found = [tfidf(text, idf) for text in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())], ["lang", "draw", "at", "x"])

    written = drawn = materialise(sample.mapInArrow(vectors, "lang string, draw long, at binary, x binary"), "language-sample")
    size = drawn.agg(F.sum(F.octet_length("at") + F.octet_length("x"))).first()[0] or 0
    if size > SAMPLE_BYTES:
        drawn = drawn.where(F.col("draw") < limits[F.col("lang")] * (SAMPLE_BYTES / size))
    # a file at a time: the driver holds the sample once
    drawn = sorted(((r["draw"], place[r["lang"]], np.frombuffer(r["at"], "<u2"), np.frombuffer(r["x"], "<f4")) for r in drawn.toLocalIterator()), key=lambda r: (r[0], r[1], len(r[2])))
    forget(written)
    learned = [(a, x, y) for k, (_, y, a, x) in enumerate(drawn) if k % CALIBRATE]
    kept = [(a, x, y) for k, (_, y, a, x) in enumerate(drawn) if k % CALIBRATE == 0]
    weights, bias = learn(learned, len(languages))
    model = LanguageModel(languages, idf, weights, bias, 1.0)
    model.temperature = fit_temperature(np.array([model.logits(a, x) for a, x, _ in kept]), np.array([y for *_, y in kept]))
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with lang_pred string and score double, which replace columns of these names.

    lang_pred is `und`, with score 0, where text is null or has no letter (and everywhere, if the model knows no
    language). Of languages that tie the first in the alphabet is named. Equal texts get equal answers, repeated rows
    each their own. An empty table gives an empty result. Texts of any length are scored whole. Columns may have any
    names but `_language_id_`, which is taken.
    """
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers for each language

    @F.pandas_udf("lang_pred string, score double")
    def answer(text):
        import pandas as pd

        found = [sent.value.predict(t) for t in text]
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    names = docs.columns
    return docs.select("*", answer(F.col(text_col)).alias("_language_id_")).select(*[F.col(f"`{c}`") for c in names], "_language_id_.lang_pred", "_language_id_.score")

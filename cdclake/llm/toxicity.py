"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are the hashed n-grams that occur in a text. From a bounded sample of labelled rows come first the ratios
r = log(share among toxic / share among clean), then a logistic regression on r-scaled features (L2 penalty).
Scoring is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import forget, materialise
from cdclake.llm.ngrams import Presence

SIZES, BITS = (4, 5, 6), 20
#: The sample: about so many labelled rows of each label.
SAMPLE_EACH = 2500
#: Added to counts; L2; rate of adaptive steps; passes over the sample.
SMOOTH, PENALTY, RATE, PASSES = 1.0, 1e-3, 0.3, 6


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by bucket: ratio times learned weight
    bias: float

    def score(self, at: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[at].sum() + self.bias, -500, 500))))


def learn(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> ToxicityModel:
    """rows: buckets that occur; weight: rows that each sampled one stands for."""
    d = 1 << BITS
    if not len(rows) or y.all() or not y.any():
        share = np.clip(float((y * weight).sum() / weight.sum()) if len(rows) else 0.0, 1e-6, 1 - 1e-6)
        return ToxicityModel(np.zeros(d), float(np.log(share / (1 - share))))
    found = np.full((2, d), SMOOTH)
    for r, k in zip(rows, y, strict=True):
        found[k][r] += 1
    ratio = np.log(found[1] / ((y == 1).sum() + 2 * SMOOTH)) - np.log(found[0] / ((y == 0).sum() + 2 * SMOOTH))
    scale = weight / weight.mean()
    w, n = np.zeros(d), np.full(d, 1.0)
    b, nb = float(np.log((y * scale).sum() / ((1 - y) * scale).sum())), 1.0
    draw = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in draw.permutation(len(rows)):  # adaptive steps for each feature
            r = ratio[rows[k]]
            z = r @ w[rows[k]] + b
            e = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[k]) * scale[k]
            g = e * r + PENALTY * w[rows[k]]
            n[rows[k]] += g * g
            w[rows[k]] -= RATE * g / np.sqrt(n[rows[k]])
            nb += e * e
            b -= RATE * e / nb**0.5
    return ToxicityModel(ratio * w, b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """The model of docs' texts that have a label. Which rows are in the sample is the same in each run.

    Rows without id, text or label don't teach; with one label only, every score is that label's share, and 0 (as
    good as) without any label. An id that several rows of docs have teaches with each of them, one with both labels
    in labels teaches both; a label that is there twice counts once. A text of any length is one vector of 2**BITS
    numbers at most. Other columns are not read.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    known = known.withColumn("draw", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    limits = {y: min(1.0, SAMPLE_EACH / n) for y, n in sizes.items()}
    chosen = known.where(" or ".join(f"y = {y} and draw < {int((1 << 30) * share)}" for y, share in limits.items()) or "false")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    texts = texts.join(F.broadcast(chosen), "id")  # about SAMPLE_EACH rows of each label

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occur = Presence(SIZES, BITS)
        for b in batches:
            found = [occur(t).astype("<u4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(3), pa.array(found, pa.binary())], ["y", "draw", "at"])

    sample = materialise(texts.select("id", "text", "y", "draw").mapInArrow(features, "y int, draw long, at binary"), "toxicity-sample", "zstd")
    drawn = [(r["draw"], r["y"], r["at"]) for r in sample.toLocalIterator()]  # a file at a time: the driver holds the sample once
    forget(sample)
    drawn.sort()
    y = np.array([r[1] for r in drawn], int)
    weight = np.array([1 / limits[k] for k in y])
    return learn([np.frombuffer(r[2], "<u4") for r in drawn], y, weight)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """docs with score double, which replaces a column of that name.

    Null text counts as empty; equal texts score alike, repeated rows each for themselves. Texts of any length are
    scored whole. An empty table gives an empty result. Columns may have any names.
    """
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    @F.pandas_udf("double")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        occur = Presence(SIZES, BITS)
        for text in texts:
            yield pd.Series([sent.value.score(occur(t or "")) for t in text], dtype="float64")

    return docs.withColumn("score", answer(F.col(text_col)))

"""Quality by importance resampling: the ratio of two generative models of hashed n-grams, sampled by Gumbel top-k.

Words and pairs of neighbouring words fall into BUCKETS buckets. The raw model counts the buckets of all texts, the
target model those of a bounded sample of texts that are labelled good. A text's log weight is the sum over its
n-grams of the log ratio of the two; with Gumbel noise added, the rows of the greatest keys are a sample without
replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import materialise
from cdclake.llm.jaccard_join import MIX1, mixed, word_hashes

BITS = 14
#: About so many good texts teach the target model.
SAMPLE = 20_000
#: Added to each bucket's count, as a share of all counts over all buckets.
SMOOTH = 1e-3
#: The threshold's search: parts of a range, and keys that the driver sorts in the end.
PARTS, FEW = 4096, 10_000


def buckets(text: str | None) -> np.ndarray:
    w = word_hashes((text or "").lower())
    pairs = mixed(w[:-1] * MIX1 + w[1:])
    return (np.concatenate((w, pairs)) >> np.uint64(64 - BITS)).astype(np.int64)


def bucket_shares(texts: DataFrame) -> np.ndarray:
    """Smoothed shares of the buckets over a one-column frame of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << BITS, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                found += np.bincount(buckets(text), minlength=1 << BITS)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # 2**BITS rows at most
    n = np.zeros(1 << BITS)
    for r in rows:
        n[r["bucket"]] = r["n"]
    n += SMOOTH * max(n.sum(), 1) / len(n)
    return n / n.sum()


def log_weights(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with log_weight double, which replaces a column of that name; good: ids of target texts, one column.

    Null text counts as empty, whose weight is 0. Without good texts every weight is 0. Equal texts weigh alike,
    repeated rows each for themselves; an id that is there twice in good counts once. Texts of any length are weighed
    whole. An empty table gives an empty result. Columns may have any names but `_id`.
    """
    docs = docs.drop("log_weight")
    known = good.select(F.col(good.columns[0]).alias("_id")).where("_id is not null").distinct()
    number = known.count()
    limit = int((1 << 30) * min(1.0, SAMPLE / max(number, 1)))
    chosen = known.where(F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 30)) < limit)  # about SAMPLE rows
    raw = bucket_shares(docs.select(text_col))
    target = bucket_shares(docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select(text_col)) if number else raw
    sent = docs.sparkSession.sparkContext.broadcast(np.log(target) - np.log(raw))

    @F.pandas_udf("double")
    def weigh(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            yield pd.Series([float(sent.value[buckets(t)].sum()) for t in text], dtype="float64")

    return docs.withColumn("log_weight", weigh(F.col(text_col)))


def kth_greatest(keys: DataFrame, k: int) -> float:
    """The k-th greatest of a one-column frame, by narrowing down the range that holds it."""
    x = keys.select(F.col(keys.columns[0]).alias("x"))
    low, high = x.agg(F.min("x"), F.max("x")).first()
    above = 0  # keys beyond the range
    while True:
        own = x.where((F.col("x") >= low) & (F.col("x") <= high))
        width = (high - low) / PARTS
        if low == high or width == 0 or low + width == low:
            return low
        part = F.least(F.floor((F.col("x") - low) / width), F.lit(PARTS - 1))
        found = own.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()  # PARTS rows at most
        for r in sorted(found, key=lambda r: -r["part"]):
            if above + r["n"] >= k:
                break
            above += r["n"]
        low, high = r["low"], r["high"]
        if r["n"] <= FEW:
            rest = sorted((y[0] for y in x.where((F.col("x") >= low) & (F.col("x") <= high)).collect()), reverse=True)
            return rest[k - above - 1]


def resample(docs: DataFrame, good: DataFrame, share: float, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, log_weight, gumbel_key, selected.

    selected marks the round(share * rows) greatest keys; rows that tie with the last of them are selected too. The
    noise depends on seed and id only, so rows that share an id (or have none) share it. An empty table gives an empty
    result. Other columns of docs are not read; texts of any length count whole.
    """
    weighed = log_weights(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), good, "doc_id", "text")
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = materialise(weighed.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_key")), "sample-keys")
    k = round(share * keyed.count())
    least = kth_greatest(keyed.select("gumbel_key"), k) if k else float("inf")
    return keyed.withColumn("selected", F.col("gumbel_key") >= least)

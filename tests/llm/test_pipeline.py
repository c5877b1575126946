"""The pipeline over a small table, each stage against what it must keep and drop."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_exact_and_near import brute_exact, brute_near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "", "en", "s", 0), (9003, "12 34", "en", "s", 5), (9004, "12 34", "en", "s", 5)], docs.schema)
    before = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL).cache()
        assert after.columns == COLUMNS
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        if name == "language_id":
            assert ids(after) == ids(docs)
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 1").collect()}
            gone = ids(before) - ids(after)
            assert len(gone & toxic) >= 0.8 * len(toxic & ids(before)) and len(gone) < 0.2 * len(rows)
        if name == "exact_dedup":
            assert ids(after) == {r[0] for r in brute_exact(rows) if r[3]}
        if name == "near_duplicates":
            assert ids(after) == {c for _, c, _ in brute_near(rows)}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    assert {r.doc_id for r in packed} == ids(before)


def test_empty_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    twice = docs.limit(3).unionByName(docs.limit(3))
    assert corpus_pipeline.drop_copies(spark, twice, SMALL).count() == 3
    assert corpus_pipeline.drop_near_copies(spark, twice, SMALL).count() == 3
    spaced = spark.createDataFrame([(1, "a b", "en", "s", 3), (1, "a  b", "en", "s", 4), (2, "a b", "en", "s", 3), (None, None, None, None, None), (None, None, None, None, None)], docs.schema)
    assert sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_copies(spark, spaced, SMALL).collect()), key=str) == [(1, "a  b"), (None, None)]


def test_odd_rows_in_every_stage(spark):
    """Null ids and texts, a text of very many words, ties, and columns that clash with the stages' own."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    long = "the quick brown fox jumps over the lazy dog and then some more " * 8000
    rows = [(None, "the cat sat on the mat and looked at the dog"), (None, "the cat sat on the mat and looked at the dog"), (None, None), (7001, long), (7002, long + "!"), (7003, ""), (7003, "")]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], docs.schema)
    before = docs.unionByName(odd)
    for name in ("score", "lang_pred", "kept", "KEY", "h", "n", "key.dotted", "sequence_id", "label"):
        before = before.withColumn(name, F.lit(name))
    columns = before.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL).cache()
        assert after.columns == columns and {r.label for r in after.select("label").collect()} == {"label"}
        texts = [(r.doc_id, r.text) for r in after.select("doc_id", "text").collect()]
        nulls = sum(1 for i, t in texts if i is None)
        assert nulls == {"language_id": 2, "toxicity": 2, "exact_dedup": 1, "near_duplicates": 1}[name]
        assert {i for i, _ in texts} & {7001, 7002} == ({7001} if name == "near_duplicates" else {7001, 7002})
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    assert sum(r.length for r in packed if r.doc_id == 7001) > 90_000

"""A training corpus from documents: language ID, toxicity, exact dedup, near-duplicate join, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import language_id, toxicity
from cdclake.llm.common import documents, forget, materialise
from cdclake.llm.exact_dedup import exact_dedup, normalised
from cdclake.llm.jaccard_join import near_duplicates
from cdclake.llm.packing import pack_best_fit
from cdclake.llm.tokens import token_pieces
from cdclake.operators.keyfilter import key_filter, with_maybe

#: Below this a language is a guess among a few; documents without a letter have none at all.
LEAST_LANGUAGE_SCORE = 0.3
SEQUENCE, END_ID = 1024, 2

#: Packing and the fitted stages go beyond SQL; they are tested against brute-force versions.
ORACLE_SQL = None


def named(columns: list[str]) -> list[Column]:
    """The columns of these names, whatever characters they have."""
    return [F.col(f"`{c}`") for c in columns]


def apart(docs: DataFrame) -> DataFrame:
    """docs with _doc_ before each name, so that a stage's own columns clash with none."""
    return docs.toDF(*[f"_doc_{c}" for c in docs.columns])


def together(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs out of what was found in apart(docs)."""
    return found.select(*named([f"_doc_{c}" for c in docs.columns])).toDF(*docs.columns)


def keep_rows(docs: DataFrame, found: DataFrame, same: dict) -> DataFrame:
    """The rows of docs that found marks as kept: same maps columns of found to what they equal in docs. One of several equal rows stays.

    Rows with equal values there have the same mark. A filter of bounded size over the ids of dropped rows is sent to
    the documents: those that pass it stay where they are, only the others are worked out and meet the dropped rows.
    Columns of docs may not begin with _keep_, nor be named _maybe, _word or _bits.
    """
    names, keys = docs.columns, [f"_keep_{name}" for name in same]
    marked = found.select("kept", *[F.col(name).alias(f"{key}_") for key, name in zip(keys, same, strict=True)])
    of_mark = [f"{key}_" for key in keys]
    dropped = marked.where("not kept").select(*of_mark)
    several = marked.where("kept").groupBy(*of_mark).count().where("count > 1").select(*of_mark)
    apart_ = dropped.unionByName(several)  # rows that may go: dropped ones, and kept ones that are there more than once
    sifted = with_maybe(docs, key_filter(apart_, of_mark[0]), "doc_id")
    asked = sifted.where("_maybe").select(*named(names), *[value.alias(key) for key, value in zip(keys, same.values(), strict=True)])
    condition = None
    for key in keys:
        one = F.col(key).eqNullSafe(F.col(f"{key}_"))
        condition = one if condition is None else condition & one
    out = asked.join(dropped.distinct(), condition, "left_anti").dropDuplicates(keys)
    return sifted.where("not _maybe").select(*named(names)).unionByName(out.select(*named(names)))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows: a letter at least, and a score of LEAST_LANGUAGE_SCORE or more.

    Null and empty texts and those without a letter go. Rows without lang don't teach but are judged; where no row
    has one, every document goes. Repeated rows are judged alike and stay as often as they are there; ids may be null
    or repeat. Texts of any length are judged whole. An empty table stays empty. Other columns stay as they are.
    """
    model = language_id.fit(docs, "text", "lang", F.col("doc_id"))
    found = language_id.predict(apart(docs), model, "_doc_text")
    return together(found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model of the labelled ones among them.

    A null text is judged as an empty one, a row without id by its text. Repeated rows are judged alike. Without labels
    among them every document stays. Texts of any length are judged whole. An empty table stays empty. Other columns
    stay as they are.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return together(toxicity.score(apart(docs), model, "_doc_text").where("score < 0.5"), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the least id (a null one last).

    Null and empty texts are one group. Of rows that repeat id and text, and of rows of one group that tie in length
    and share the id, one stays. Texts of any length are compared whole. An empty table stays empty. Other columns
    stay as they are.
    """
    found = materialise(exact_dedup(docs).select("kept", "doc_id", "n_chars", "text_sha256"), "pipeline-copies")
    text = F.coalesce("text", F.lit(""))
    return keep_rows(docs, found, {"doc_id": F.col("doc_id"), "n_chars": F.char_length(text), "text_sha256": F.sha2(normalised(text).cast("binary"), 256)})


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group that is connected through likenesses of 0.8 or more.

    Texts without words, null ones too, are one group. A group without any id keeps one row. Of rows that repeat id
    and text one stays; of others that share the least id, the one whose text has the least md5. Texts of any length
    count whole. An empty table stays empty. Other columns stay as they are.
    """
    found = materialise(near_duplicates(docs).select("kept", "doc_id", "text_md5"), "pipeline-near")
    return keep_rows(docs, found, {"doc_id": F.col("doc_id"), "text_md5": F.md5(F.coalesce("text", F.lit("")).cast("binary"))})


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most SEQUENCE ids.

    A null or empty text is one piece of the end id. Rows that repeat, or share an id, are packed each for themselves.
    A text of any length is as many pieces as it takes. An empty table gives an empty result. Other columns are not
    read.
    """
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, END_ID)
    return pack_best_fit(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), SEQUENCE)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

Only DataFrame functions run here. A text's five-word shingles are hashed once; the top bits of a hash choose one of
BINS bins, in which the least hash stays. A bin without hashes borrows that of the first bin with any in a random
order of its own (the order depends on the bin only, so equal sets borrow alike). Of each bin's value the low byte is
stored. Two fingerprints' share of equal bytes, corrected for chance equality, estimates the Jaccard likeness of the
shingle sets.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.common import SPACES, materialise

WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
#: Bits of a hash that count: the bin, then the value in it.
HASH_BITS = 60
VALUE = (1 << (HASH_BITS - BIN_BITS)) - 1
#: Bins that an empty bin asks in turn; after these it takes the filled bin of the least hash with its own number.
PROBES = 12
#: Rows of one block of the id order, up to so many blocks (as many tasks of 1.5 GB as 100 TB have); sampled keys for each block.
BLOCK_ROWS, MOST_BLOCKS, SAMPLE_EACH = 1000, 65_536, 10


def let(value: Column, then) -> Column:
    """then(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def shingle_hashes(text: Column) -> Column:
    """Hashes of all runs of five words; a text of fewer words is one run, an empty one has none."""

    def runs(hashes: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.size(hashes) - WORDS), lambda k: F.xxhash64(*[F.get(hashes, k + j) for j in range(WORDS)]))
        return F.when(F.size(hashes) >= WORDS, own).when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))

    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")  # no pattern to match
    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def signature(text: Column) -> Column:
    """BINS low bytes, less 128 each, as array<tinyint>; empty for a text without words."""
    none = F.array([F.lit(b << (HASH_BITS - BIN_BITS) | VALUE) for b in range(BINS)])  # sorts last in its bin

    def least(hashes: Column) -> Column:
        ordered = F.sort_array(F.concat(F.transform(hashes, lambda h: h.bitwiseAND(F.lit((1 << HASH_BITS) - 1))), none))
        shift = HASH_BITS - BIN_BITS
        first = let(ordered, lambda s: F.filter(s, lambda h, k: (k == 0) | (F.shiftright(h, shift) != F.shiftright(F.get(s, k - 1), shift))))
        return F.transform(first, lambda h: F.when(h.bitwiseAND(F.lit(VALUE)) != VALUE, h.bitwiseAND(F.lit(VALUE))))

    draw = random.Random(20)
    probes = [F.array([F.lit(draw.randrange(BINS)) for _ in range(BINS)]) for _ in range(PROBES)]

    def densified(bins: Column) -> Column:
        filled = F.filter(F.transform(bins, lambda v, b: F.struct(b.alias("b"), v.alias("v"))), lambda x: x["v"].isNotNull())

        def borrowed(full: Column) -> Column:
            def last(b: Column) -> Column:
                return F.array_min(F.transform(full, lambda x: F.struct(F.xxhash64(b, x["b"]).alias("h"), x["v"].alias("v"))))["v"]

            return F.transform(bins, lambda v, b: F.coalesce(v, *[F.get(bins, F.get(p, b)) for p in probes], last(b)))

        return let(filled, borrowed)

    def of(hashes: Column) -> Column:
        dense = let(least(hashes), densified)
        return F.when(F.size(hashes) > 0, F.transform(dense, lambda v: (v.bitwiseAND(F.lit(255)) - 128).cast("tinyint"))).otherwise(F.array().cast("array<tinyint>"))

    return let(shingle_hashes(text), of)


def packed(signature: Column) -> Column:
    """Two hexadecimal digits for each byte; the empty string for no words."""
    digits = F.array([F.lit(f"{b:02x}") for b in range(256)])
    return F.array_join(F.transform(signature, lambda v: F.get(digits, v + 128)), "")


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard estimate, 0 to 1, less what chance makes equal. Two texts without words are alike, one of them is not."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (equal - 1 / 256) / (1 - 1 / 256))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(estimate)


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with the packed fingerprint of each whole text. Null text counts as empty, which has an empty fingerprint."""
    return docs.withColumn(out, packed(signature(F.coalesce(F.col(text_col), F.lit("")))))


def with_next(rows: DataFrame, id_col: str, text_col: str, columns: list[str]) -> DataFrame:
    """rows with next_<c> for each of columns: the value in the row that follows by descending id; the first follows the last.

    Ids are of a type that sorts (whole numbers, strings, dates, decimals). Rows with equal ids, null ones too, follow
    each other by descending hash of the text, then text; null ids come last. The order is cut into blocks of about
    BLOCK_ROWS rows at sampled places of (id, hash), so that many rows of one id are more than one block; each block
    gets a copy of the row that follows its last one, so no task sees more than a block. Columns may not begin with _nx_.
    """
    keyed = rows.withColumn("_nx_key", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")))
    number = rows.count()
    blocks = min(-(-number // BLOCK_ROWS), MOST_BLOCKS)
    # about SAMPLE_EACH * MOST_BLOCKS keys at most
    sampled = [r[0].asDict() for r in keyed.select("_nx_key").sample(min(1.0, SAMPLE_EACH * blocks / number), 5).collect()] if blocks > 1 else []
    sampled.sort(key=lambda k: (k["id"] is not None, k["id"] if k["id"] is not None else 0, k["h"]))
    cuts = sampled[SAMPLE_EACH // 2 :: SAMPLE_EACH]
    cuts = [c for k, c in enumerate(cuts) if not k or c != cuts[k - 1]]
    # the number of cuts below a key, through groups of cuts
    group = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k : k + group] for k in range(0, len(cuts), group)]
    kind = keyed.schema["_nx_key"].dataType.simpleString()

    def block(of: Column) -> Column:
        if not cuts:
            return F.lit(0)
        lasts = F.from_json(F.lit(json.dumps([g[-1] for g in groups], default=str)), f"array<{kind}>")
        all_cuts = F.from_json(F.lit(json.dumps(groups, default=str)), f"array<array<{kind}>>")
        coarse = F.size(F.filter(lasts, lambda c: c < of))
        fine = let(F.get(all_cuts, coarse), lambda own: F.size(F.filter(own, lambda c: c < of)))
        return coarse * group + F.when(coarse < len(groups), fine).otherwise(0)

    placed = keyed.withColumn("_nx_block", block(F.col("_nx_key")))
    heads = placed.groupBy("_nx_block").agg(F.max("_nx_key").alias("_nx_head"))  # MOST_BLOCKS rows at most
    after = F.coalesce(F.lead("_nx_block").over(Window.orderBy("_nx_block")), F.min("_nx_block").over(Window.partitionBy()))
    heads = materialise(heads.withColumn("_nx_before", after), "next-heads")  # ids descend: the block before has the greater ids
    placed = placed.join(F.broadcast(heads), "_nx_block")
    leads = F.col("_nx_key") == F.col("_nx_head")
    to = F.when(leads, F.array("_nx_block", "_nx_before")).otherwise(F.array("_nx_block"))
    placed = placed.select(*[F.col(f"`{c}`") for c in rows.columns], "_nx_key", F.posexplode(to).alias("_nx_copy", "_nx_in"))
    order = Window.partitionBy("_nx_in").orderBy("_nx_copy", F.col(id_col).desc_nulls_last(), F.col("_nx_key.h").desc(), F.col(text_col).desc())
    return placed.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("_nx_copy = 0").drop("_nx_copy", "_nx_in", "_nx_key")


def edited_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs, its fingerprint beside that of its edited text and the likeness to that and to the next document.

    Returns doc_id, n_chars, edited (the text whose last third is replaced by the next document's beginning),
    fingerprint, edited_fingerprint, near_edited, near_next. The next document is that of with_next. Null text counts
    as empty; a single document follows itself; rows that share an id are documents of their own, and rows that repeat
    id and text follow each other. Texts of any length count whole. An empty table gives an empty result. Other columns
    are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = base.withColumn("mark", signature(F.col("text")))
    rows = with_next(marked, "doc_id", "text", ["text", "mark"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "mark", "next_mark")
    rows = rows.withColumn("edited_mark", signature(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        packed(F.col("mark")).alias("fingerprint"),
        packed(F.col("edited_mark")).alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )

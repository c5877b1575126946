"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one row of each group.

Only DataFrame functions run here. Three passes:

1. a narrow table (id, code points, hash, sha-256) is written once, then its groups of two rows or more;
2. texts of these groups are verified: the least and the greatest text of a group are the same bytes, or the hash
   collided. A filter of bounded size over the groups' hashes is sent to all tasks, so that texts of other rows don't
   leave theirs, but for those that share a bit with a group (they verify alone, which does no harm). Texts of hot
   groups are salted, so one group never meets in one task;
3. rows get their group's keeper by an equi-join on narrow rows, hot groups salted again. Rows of no group are their own.

Where a hash did collide, the group's rows part by their sha-256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import HOT_ROWS, HOT_SHARE, SALTS, SPACES, forget, join_counted, materialise
from cdclake.operators.keyfilter import key_filter, with_maybe


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def hash128(norm: Column) -> Column:
    return F.unhex(F.md5(norm.cast("binary")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_chars (code points of the original).

    Null text counts as empty, and empty texts are one group. The row with the most code points in its original
    text stays, then the one with the smallest id (of any type that sorts); a null id loses against any other. Rows
    that repeat both id and text are one row written twice: they get the same verdict, and group_size counts each of
    them. Texts of any length are compared whole. An empty table gives an empty result. Other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    norm = base.select("doc_id", F.char_length("text").alias("n"), normalised(F.col("text")).alias("norm"))
    narrow = materialise(norm.select("doc_id", "n", content_hash(F.col("norm")).alias("h"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "dedup-keys")
    total = narrow.count()
    several = groups(narrow)

    texts = norm.select(F.monotonically_increasing_id().alias("row"), "norm", content_hash(F.col("norm")).alias("h"))
    texts = with_maybe(texts, key_filter(several, "h"), "h").where("_maybe")
    # the bytes of a hot group meet in as many parts as its rows are salted by
    hot = several.where(F.col("group_size") > max(HOT_ROWS, int(total * HOT_SHARE))).select(F.col("h").alias("hot_h"))  # 1 / HOT_SHARE rows at most
    salt = F.when(F.col("hot_h").isNotNull(), F.pmod("row", F.lit(SALTS))).otherwise(F.lit(0)).alias("salt")
    texts = texts.join(F.broadcast(hot), F.col("h") == F.col("hot_h"), "left").select("h", "norm", salt)
    extremes = texts.groupBy("h", "salt").agg(F.min("norm").alias("least"), F.max("norm").alias("most"))
    collided = extremes.groupBy("h").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least <> most").select("h", F.lit(True).alias("collided"))
    collided = materialise(collided, "dedup-collided")

    if collided.isEmpty():
        forget(collided)
    else:
        narrow = narrow.join(collided, "h", "left").select("doc_id", "n", "text_sha256", F.when(F.col("collided"), F.unhex("text_sha256")).otherwise(F.col("h")).alias("h"))
        several = groups(narrow)
    found = join_counted(narrow, several, "h", "group_size", total, "left")
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("best.id")).otherwise(F.col("doc_id"))
    leads = F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("n") == -F.col("best.less"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, leads).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
        F.col("n").cast("long").alias("n_chars"),
    )


def groups(narrow: DataFrame) -> DataFrame:
    """(h, group_size, best) of the hashes that several rows have."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    return materialise(narrow.groupBy("h").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).where("group_size > 1"), "dedup-groups")

"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, met by every window of the training texts.

Only DataFrame functions run here. A text is its words in lower case (A to Z). A benchmark item's windows are its runs
of WINDOW words, or all its words where it has fewer. One scan of the documents:

1. each text becomes its words, their hashes, and a hash of each window's first HEAD words;
2. these meet the broadcast set of such heads in the task that made them; windows that get through are hashed whole,
   meet the broadcast set of windows, and each hit is verified word by word. Others never leave their task;
3. hits are narrow rows; those of a row of documents are merged into ranges of words by a running maximum.

A mark at the end of each row's windows meets a mark in the set, so that a row without hits isn't lost. A set of more
than SET_ROWS windows is broadcast in blocks, each with a scan of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.common import forget, materialise

WINDOW, HEAD = 10, 4
#: Windows, and items that they are of, that one broadcast holds at most (some 200 bytes each).
SET_ROWS = 1_000_000
#: What stands between words, as a Java character class (after A to Z are small, and before).
BETWEEN, BETWEEN_RAW = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
LARGE, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The hash that stands for the end of a row; a window that hashes to it is told apart by its place.
END = -1


def small(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, LARGE, SMALL))


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.array_remove(F.split(small(F.coalesce(text, F.lit(""))), f"{BETWEEN}+"), "")


def with_heads(rows: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """rows with words, their number n_words, and the hashes of the heads of their windows, one length after the other."""
    out = rows.withColumn("words", words_of(F.col(text))).drop(text)
    # columns that are used more than once stay columns: nothing is worked out again for each window
    out = out.withColumns({"n_words": F.size("words").cast("long"), "_hashes": F.transform("words", lambda w: F.xxhash64(w))})

    def heads(k: int) -> Column:
        number = F.size("_hashes") - (k - 1)
        hashed = F.transform(F.sequence(F.lit(0), number - 1), lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(min(k, HEAD))]))
        return F.when(number > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    return out.withColumn("_heads", F.concat(*[heads(k) for k in lengths], F.array(F.lit(END).cast("bigint")))).drop("_hashes")


def hash_of(words: str, start: Column, number: int) -> Column:
    return F.xxhash64(*[F.xxhash64(F.get(words, (start + j).cast("int"))) for j in range(number)])


def windows_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct windows of a benchmark: head and h (hashes), k, window (array of k words), items (array of ids as strings).

    Items that repeat a window, an id or a whole row count once. A null id gives its windows no item. Null texts and
    those without words have no window.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    items = items.withColumn("words", words_of(F.col("text"))).where(F.size("words") > 0)
    k = F.least(F.size("words"), F.lit(WINDOW))
    placed = items.withColumn("k", k).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("k"))))
    cut = placed.select("item", "k", F.slice("words", F.col("at") + 1, F.col("k")).alias("window"))
    head, h = F.lit(END).cast("bigint"), F.lit(END).cast("bigint")
    for n in range(1, WINDOW + 1):
        head = F.when(F.col("k") == n, hash_of("window", F.lit(0), min(n, HEAD))).otherwise(head)
        h = F.when(F.col("k") == n, hash_of("window", F.lit(0), n)).otherwise(h)
    return cut.groupBy("k", "window").agg(F.collect_set("item").alias("items")).withColumns({"head": head, "h": h})


def hits(base: DataFrame, found: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """The windows of base (text, keep) that are in found, as (keep, n_words, start, stop, items); one row without start for each row of base."""
    # outer: the array is never empty, and the planner would ask that of a copy of the whole expression, below
    rows = with_heads(base, "text", lengths).select(*keep, "words", "n_words", F.posexplode_outer("_heads").alias("_at", "_head"))
    marks = {"head": F.lit(END).cast("bigint"), "h": F.lit(END).cast("bigint"), "k": F.lit(0), "window": F.lit(None).cast("array<string>"), "items": F.lit(None).cast("array<string>")}
    every = found.unionByName(base.sparkSession.range(1).select(*[value.alias(name) for name, value in marks.items()]))
    met = rows.join(F.broadcast(every.select("head", F.col("k").alias("_k")).distinct()), F.col("_head") == F.col("head"))
    # the place in the array tells the window's length and its first word
    k, start, before = F.lit(0), F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    for n in lengths:
        number = F.greatest(F.col("n_words") - (n - 1), F.lit(0))
        inside = (F.col("_at") >= before) & (F.col("_at") < before + number)
        k, start, before = F.when(inside, n).otherwise(k), F.when(inside, F.col("_at") - before).otherwise(start), before + number
    met = met.withColumn("start", start).where(F.col("_k") == k).drop("head")
    h = F.lit(END).cast("bigint")
    for n in lengths:
        h = F.when(F.col("_k") == n, hash_of("words", F.col("start"), n)).otherwise(h)
    met = met.withColumn("_h", h).join(F.broadcast(every.drop("head")), (F.col("_h") == F.col("h")) & (F.col("_k") == F.col("k")))
    for j in range(max(lengths, default=0)):
        met = met.where((F.col("k") <= j) | (F.get("words", (F.col("start") + j).cast("int")) == F.get("window", F.lit(j))))
    return met.select(*keep, "n_words", "start", (F.col("start") + F.col("k")).alias("stop"), "items")


def contaminated_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each row of docs: row (a number of its own), doc_id, n_words, ranges, n_hit, items.

    ranges: the runs of words (start to before stop, from 0) that lie in an occurrence of a benchmark window, in
    order, apart; n_hit: their words; items: the ids as strings, sorted, of the items with a window there. Null and
    empty texts have no words. Rows may repeat or share an id: each stands for itself. Texts of any length are scanned
    whole; a row of words is held by one task. An empty table gives an empty result, an empty benchmark no hit. Other
    columns are not read.
    """
    found = materialise(windows_of(benchmark, item_col, item_text_col), "benchmark-windows")
    lengths = sorted(r[0] for r in found.select("k").distinct().collect())  # WINDOW of them at most
    size = found.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    blocks = max(1, -(-size // SET_ROWS))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if blocks > 1:
        base = materialise(base, "benchmark-rows")  # its numbers are the same in each scan
    met = reduce(DataFrame.unionByName, [hits(base, found.where(F.pmod("h", F.lit(blocks)) == b) if blocks > 1 else found, lengths, ["row", "doc_id"]) for b in range(blocks)])
    met = materialise(met, "benchmark-hits")
    forget(found, base if blocks > 1 else None)
    # hits in order: one that begins behind all before it opens a range. Nulls, the rows' marks, come first
    order = Window.partitionBy("row").orderBy("start")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("start").isNotNull() & (reach.isNull() | (F.col("start") > reach))
    numbered = met.withColumn("_opens", opens.cast("int")).withColumn("_range", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("row", "_range").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.collect_set("items").alias("sets"))
    place = F.when(F.col("start").isNotNull(), F.struct("start", "stop"))
    out = merged.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.collect_list(place)).alias("ranges"), F.flatten(F.collect_list("sets")).alias("sets"))
    number = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["stop"] - r["start"])
    return out.select("row", "doc_id", "n_words", "ranges", number.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, spans: bool = False, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without contaminated documents; spans: with them, but without the words that were hit and what stands between those and the next.

    Documents without a hit keep their text, null too, byte for byte. Repeated rows are treated alike. An empty table
    stays empty. Other columns stay as they are; none may be named _row.
    """
    rows = materialise(docs.select("*", F.monotonically_increasing_id().alias("_row")), "benchmark-docs")
    ranges = contaminated_words(rows, benchmark, "_row", text_col, item_col, item_text_col).where("n_hit > 0")
    dirty = materialise(ranges.select(F.col("doc_id").alias("_row"), F.col("ranges").alias("_ranges")), "benchmark-dirty")
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not spans:
        return rows.join(dirty.select("_row"), "_row", "left_anti").select(*names)
    text = F.col(f"`{text_col}`")
    parts = F.regexp_extract_all(text, F.lit(f"(?:(?!{BETWEEN_RAW})[\\s\\S])+{BETWEEN_RAW}*"), F.lit(0))
    kept = F.filter(parts, lambda _, i: ~F.exists("_ranges", lambda r: (i >= r["start"]) & (i < r["stop"])))
    cut = F.concat(F.regexp_extract(text, f"^{BETWEEN_RAW}*", 0), F.array_join(kept, ""))
    joined = rows.join(dirty, "_row", "left").withColumn("_cut", F.when(F.col("_ranges").isNotNull(), cut).otherwise(text))
    return joined.select(*[F.col("_cut").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])

"""Counters and sizes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def merge_counters(spark: SparkSession, manifest: dict, db: str) -> DataFrame:
    """(db, table, action, n) of all merges into a store's tables, from its manifest."""
    rows = [(db, table, action, n) for table, own in manifest.get("counters", {}).items() for action, n in own.items()]
    return spark.createDataFrame(rows, "db string, table string, action string, n long")


#: Ranks of the latencies in operation_metrics; on both sides of one, the share of the rows among which its latency is looked for.
RANKS, NEAR = (0.5, 0.9, 0.99), 0.001


def operation_metrics(rows: DataFrame, by: list[str], latency: str | None = None) -> DataFrame:
    """Rows for each label combination, with the exact quantiles at RANKS of a latency column (null: left out) where one is given.

    A quantile at q of n latencies is the smallest one that at least q * n of them don't exceed. Approximate quantiles cut each
    combination's latencies into ranges, which are counted; only those of the ranges that hold a quantile, about NEAR
    of them, are ranked. A cut that is off makes its ranges larger, no result wrong. Columns may not begin with an underscore.
    """
    counted = F.count(F.lit(1)).alias("n")
    if not latency:
        return rows.groupBy(*by).agg(counted)
    near = sorted({min(1.0, max(0.0, q + side * NEAR)) for q in RANKS for side in (-1, 1)})
    labels = rows.groupBy(*by).agg(counted, F.count(latency).alias("_n"), F.percentile_approx(latency, near).alias("_cuts"))

    def meet(left: DataFrame, right: DataFrame, keep: list[str], how: str) -> DataFrame:
        """left with columns keep of right's row of the same labels, nulls alike."""
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        return left.join(right.select(*[F.col(c).alias(f"_of_{c}") for c in by], *keep), same, how).select(*left.columns, *keep)

    own = rows.where(F.col(latency).isNotNull()).select(*by, F.col(latency).alias("_x"))
    ranged = meet(own, labels, ["_cuts"], "inner").select(*by, "_x", F.size(F.filter("_cuts", lambda c: c < F.col("_x"))).alias("_range"))
    # a few ranges for each combination
    sizes = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    upto = sizes.withColumn("_upto", F.sum("_rows").over(Window.partitionBy(*by).orderBy("_range")))
    places = F.array(*[F.ceil(F.col("_n") * F.lit(Decimal(str(q)))).cast("long") for q in RANKS])
    asked = meet(upto, labels.select(*by, places.alias("_places")), ["_places"], "inner")
    held = F.filter("_places", lambda k: (k <= F.col("_upto")) & (k > F.col("_upto") - F.col("_rows")))
    chosen = asked.select(*by, F.col("_range").alias("_in"), (F.col("_upto") - F.col("_rows")).alias("_before"), "_places", held.alias("_held")).where(F.size("_held") > 0)
    same = F.col("_range") == F.col("_in")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    few = ranged.join(chosen.select(*[F.col(c).alias(f"_of_{c}") for c in by], "_in", "_before", "_places", "_held"), same)
    distinct = few.groupBy(*by, "_range", "_x", "_before", "_places", "_held").agg(F.count(F.lit(1)).alias("_rows"))
    ranked = distinct.withColumn("_upto", F.col("_before") + F.sum("_rows").over(Window.partitionBy(*by, "_range").orderBy("_x")))
    hit = F.filter("_held", lambda k: (k <= F.col("_upto")) & (k > F.col("_upto") - F.col("_rows")))
    found = ranked.withColumn("_hit", hit).where(F.size("_hit") > 0)
    at = F.map_from_entries(F.flatten(F.collect_list(F.transform(F.array_distinct("_hit"), lambda k: F.struct(k, F.col("_x"))))))
    quantiles = found.groupBy(*by).agg(F.first("_places").alias("_places"), at.alias("_at"))
    taken = quantiles.select(*by, F.transform("_places", lambda k: F.element_at("_at", k)).alias("latency"))
    return meet(labels, taken, ["latency"], "left").drop("_n", "_cuts")


#: Size of a latency sketch: a quantile's rank is off by at most RANK_ERROR of all rows, with 99 % probability.
SKETCH, RANK_ERROR = 200, 0.0165


def latency_sketches(rows: DataFrame, by: list[str], latency: str) -> DataFrame:
    """Rows and a sketch of the latencies (KLL) for each label combination; sketches of many batches add up."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(latency).cast("double"), SKETCH).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of several batches (or labels) as one for each combination of by."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH).alias("sketch"))


def latency_quantiles(sketches: DataFrame, at: list[float]) -> DataFrame:
    """The latencies at these ranks as an array, in place of the sketch; no row's rank is exact, see RANK_ERROR."""
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(q)) for q in at]))
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], found.alias("latency"))


def file_stats(table: DataFrame, by: list[str], least: int = 0) -> DataFrame:
    """Files and rows of each partition that has more than least files."""
    return table.groupBy(*by).agg(F.countDistinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("rows")).where(F.col("files") > least)


def table_megabytes(table: DataFrame, copies: int = 1) -> float:
    """Size of a table's files in MB, divided by the copies that the store keeps."""
    spark, jvm = table.sparkSession, table.sparkSession.sparkContext._jvm
    total = 0
    for f in table.inputFiles():  # the driver's own file listing
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total / copies / 1024**2


def progress(ledger: DataFrame, by: list[str], finished: tuple[str, ...] = ("SUCCESS",)) -> DataFrame:
    """Of each group of tasks: finished, total and their ratio."""
    done = F.count(F.when(F.col("status").isin(*finished), 1))
    out = ledger.groupBy(*by).agg(done.alias("finished"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("ratio", F.col("finished") / F.col("total"))

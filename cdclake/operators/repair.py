"""Duplicate detection and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_partitions(rows: DataFrame, key: Column, by: list[str]) -> DataFrame:
    """Partitions whose ids aren't distinct: by, distinct_ids, ids, surplus. Null ids don't count."""
    counts = rows.groupBy(*by).agg(F.countDistinct(key).alias("distinct_ids"), F.count(key).alias("ids"))
    return counts.where("distinct_ids <> ids").withColumn("surplus", F.col("ids") - F.col("distinct_ids"))


def ranked(rows: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """rows without null keys, with rowno: 1 for the newest row of each key. newest has to order rows totally."""
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.withColumn("rowno", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))


def in_partitions(rows: DataFrame, partitions: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(partitions.select(*by), by, "left_semi")


def validation(rows: DataFrame, key: Column, rank: Column | None = None) -> DataFrame:
    """One row: distinct_ids, ids, first_rows (rank 1; null without rank), valid (no id is there twice)."""
    first = F.count(F.when(rank == 1, key)) if rank is not None else F.lit(None).cast("bigint")
    out = rows.agg(F.countDistinct(key).alias("distinct_ids"), F.count(key).alias("ids"), first.alias("first_rows"))
    return out.withColumn("valid", (F.coalesce("first_rows", "ids") == F.col("distinct_ids")))


def repaired(rows: DataFrame, keys: list[str], newest: list[Column], by: list[str]) -> DataFrame:
    """rows whose flagged partitions hold one row for each key; keys are deduplicated across all flagged partitions."""
    key = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    flagged = duplicate_partitions(rows, F.when(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)), F.lit(None)).otherwise(key), by)
    clean = rows.join(flagged.select(*by), by, "left_anti")
    unique = ranked(in_partitions(rows, flagged, by), keys, newest).where("rowno = 1").drop("rowno")
    return clean.unionByName(unique)

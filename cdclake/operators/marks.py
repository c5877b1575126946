"""High-water marks: (scope, stream_update_time, check_update_time); a scope is `db.table` or `db.table_partition`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "scope string, stream_update_time bigint, check_update_time bigint"


def scope(db: str, table: str, partition: str | None = None) -> str:
    return f"{db}.{table}_{partition}" if partition else f"{db}.{table}"


def advanced(marks: DataFrame, fresh: DataFrame) -> DataFrame:
    """marks with fresh ones in; none goes back."""
    both = marks.unionByName(fresh, allowMissingColumns=True)
    return both.groupBy("scope").agg(F.max("stream_update_time").alias("stream_update_time"), F.max("check_update_time").alias("check_update_time"))


def set_check_time(spark: SparkSession, marks: DataFrame, scopes: list[str], at_ms: int) -> DataFrame:
    """marks whose check time is at_ms for the scopes, whatever it was."""
    named = spark.createDataFrame([(s, at_ms) for s in scopes], "scope string, _at bigint")
    out = marks.join(named, "scope", "full")
    return out.select("scope", "stream_update_time", F.coalesce("_at", "check_update_time").alias("check_update_time"))

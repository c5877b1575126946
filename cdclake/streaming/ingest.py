"""Ingest of many databases: a query for each, set up from settings, stopped together."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdclake.config import Settings
from cdclake.functions import update_ms
from cdclake.operators.envelope import flatten, partitioned
from cdclake.operators.merge import COMBINED, Policy
from cdclake.sources.store import Store
from cdclake.streaming.merge import merge_stream


def change_batch(envelopes: DataFrame, update: str, seq: str) -> DataFrame:
    """Envelopes {before, after, op, key, seq} as a batch to merge: keys, values, op, ut, seq and partition columns."""
    rows = partitioned(flatten(envelopes))
    after = rows.schema["after"].dataType
    keys = rows.schema["key"].dataType.fieldNames()
    values = [f.name for f in after if f.name not in keys]
    at = update_ms(F.col(f"after.`{update}`"), after[update].dataType.simpleString())
    return rows.select(*[F.col(f"key.`{k}`").alias(k) for k in keys], "op", at.alias("ut"), seq, *[F.col(f"after.`{v}`").alias(v) for v in values], "p_y", "p_m", "p_d")


def ingest(spark: SparkSession, settings: Settings, source: Callable[[str], DataFrame], prepare: Callable[[DataFrame], DataFrame], keys: list[str], policy: Policy = COMBINED, once: bool = False) -> dict[str, StreamingQuery]:
    """A merging query for each database of the settings, by target name, into a store under settings.root.

    source gives a database's stream; sources bound their batches themselves (files or rows per trigger). once: what
    is there, else a batch every settings.file_minutes.
    """
    queries = {}
    for name, target in settings.databases.items():
        store = Store(spark, f"{settings.root}/{target}", list(settings.partition_columns))
        checkpoint = f"{settings.root}/_checkpoints/{target}"
        queries[target] = merge_stream(source(name), store, keys, checkpoint, policy, prepare, None if once else f"{settings.file_minutes} minutes", f"{settings.root}/_pending/{target}")
    return queries


def run_until(spark: SparkSession, queries: dict[str, StreamingQuery], marker: str, seconds: float = 5.0) -> None:
    """Let queries run until a file of the marker's name appears, then stop each between two batches; a query that fails raises its error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(marker)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while any(q.isActive for q in queries.values()) and not fs.exists(path):
        time.sleep(seconds)
    for q in queries.values():
        while q.isActive and q.status["isTriggerActive"]:
            time.sleep(min(seconds, 0.2))
        q.stop()
        if q.exception() is not None:
            raise q.exception()

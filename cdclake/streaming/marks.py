"""High-water marks of a stream of changes: a watermarked aggregate, whose updates only ever raise the stored marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdclake.operators.merge import APPLIED
from cdclake.sources.store import Conflict, Store
from cdclake.streaming.merge import ATTEMPTS


def marks_of(changes: DataFrame, by: list[str], late: str) -> DataFrame:
    """(by, day, mark): the greatest applied ut of each partition and day, as a streaming aggregate.

    Days that the watermark, `late` behind the greatest ut, has passed leave the state; changes of such days drop out,
    so `late` must be as long as changes of a partition may come behind those of others.
    """
    applied = changes.where(F.col("action").isin(*APPLIED)).withColumn("_at", F.timestamp_millis("ut")).withWatermark("_at", late)
    return applied.groupBy(*by, F.window("_at", "1 day").alias("day")).agg(F.max("ut").alias("mark"))


def raise_marks(store: Store, fresh: DataFrame, by: list[str], batch_id: str | None = None, table: str = "stream_marks") -> int:
    """Take marks (by, mark) into the stored ones; none goes back, and a batch that was taken in changes nothing."""
    for attempt in range(ATTEMPTS):
        base = store.manifest()
        if store.has_batch(base, batch_id):
            return base["version"]
        before = store.read(table, base=base)
        every = fresh.select(*by, "mark")
        every = every if before is None else every.unionByName(before)
        try:
            return store.commit({table: every.groupBy(*by).agg(F.max("mark").alias("mark"))}, batch_id=batch_id, base=base)
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def marks_stream(changes: DataFrame, store: Store, by: list[str], checkpoint: str, late: str = "30 days", every: str | None = None, table: str = "stream_marks") -> StreamingQuery:
    """A query that keeps the marks of a stream of changes (see streaming.state.versioned) in a store; every: its trigger's interval, else all that is there and stop."""

    def upsert(batch: DataFrame, number: int) -> None:
        raise_marks(store, batch, by, f"{checkpoint}#{number}", table)

    writer = marks_of(changes, by, late).writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

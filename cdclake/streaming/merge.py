"""Merging a stream of change rows into a snapshot store, batch by batch.

The index names each key's partition and is parted by a hash of the key. A batch reads the parts of the index that
its keys fall into, then the partitions of rows that the index and the batch name, and writes these alone.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.operators.merge import APPLIED, COMBINED, DataDelayed, Policy, actions, apply, high_water_marks, index_of, missing_keys, observed
from cdclake.operators.tasks import DELAY_HOURS, MOST_ATTEMPTS
from cdclake.sources.store import BUCKET, Conflict, Store, part_keys

ATTEMPTS = 3
#: Number types, each of which takes in those before it (and whose files Spark reads as a later one).
NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def index_table(store: Store, base: dict, empty: DataFrame, keys: list[str], buckets: list[int] | None = None) -> DataFrame:
    """The index of a snapshot, or its parts of some buckets."""
    if "index" not in base["tables"]:
        return empty.limit(0).select(*keys, "ut", F.lit(True).alias("live"), *store.by)
    if not base["by"].get("index") or buckets is None:
        return store.read("index", base=base).drop(BUCKET)
    return store.read("index", base=base, only=bucket_keys(buckets)).drop(BUCKET)


def bucket_keys(buckets: list[int]) -> list[str]:
    return [json.dumps([str(b)]) for b in buckets]


def with_bucket(index: DataFrame, store: Store, keys: list[str]) -> DataFrame:
    return index.withColumn(BUCKET, bucket_of(keys, store.index_buckets))


def commit_index(store: Store, fresh: DataFrame, keys: list[str], base: dict, tables: dict[str, DataFrame] | None = None, touched: dict | None = None) -> int:
    """Publish a whole index, each part sorted by key, with other tables."""
    every = bucket_keys(list(range(store.index_buckets)))
    return store.commit({"index": with_bucket(fresh, store, keys)} | (tables or {}), {"index": every} | (touched or {}), base=base, by={"index": [BUCKET]}, sort={"index": keys})


def rebuild_index(store: Store, keys: list[str], table: str = "rows", predicate: str | None = None) -> int:
    """An index from the rows of one snapshot; tombstones stay, and entries of what the predicate leaves out."""
    base = store.manifest()
    fresh = index_of(store.read(table, predicate=predicate, base=base), keys, store.by)
    if "index" in base["tables"]:
        old = index_table(store, base, fresh, keys)
        fresh = fresh.unionByName(old.join(fresh.select(*keys), keys, "left_anti"))
    return commit_index(store, fresh, keys, base)


def merge_batch(store: Store, batch: DataFrame, keys: list[str], policy: Policy = COMBINED, batch_id: str | None = None, table: str = "rows") -> int:
    """Merge a batch (keys, op, ut, seq, values) and commit rows, index and marks as one snapshot; returns its version.

    Partitions that no applied row touches, before or after, aren't read and keep their files, as do parts of the
    index that no key of the batch falls into; a store without partition columns has its rows rewritten whole. Marks
    are kept for the table and for each partition, counters of the actions in the manifest. A batch that is in the store already changes nothing. If another
    writer commits first, the merge goes on top of that where they touched different partitions and parts of the index,
    else it is worked out again on that snapshot.

    The table's columns are those of all its batches: a new one is null in older rows, one that a batch lacks is null
    in the rows that it brings, and numbers get the wider type. Types that don't go together fail the merge.
    """
    by = store.by
    batch = batch.persist()  # read for its parts of the index and for its actions, in each attempt
    try:
        return _merge_batch(store, batch, keys, policy, batch_id, table, by)
    finally:
        batch.unpersist()


def merged_types(store: Store, base: dict, table: str, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch with its columns in the types that the table and it share; fails where there is none. Keys can't widen: their hash says where they are."""
    if table not in base["tables"]:
        return batch
    known = {f.name: f.dataType for f in store.schema(table, base)}
    casts = {}
    for c in batch.columns:
        own, old = batch.schema[c].dataType, known.get(c, batch.schema[c].dataType)
        if own == old:
            continue
        wider = [NUMBERS.index(type(t)) for t in (own, old) if type(t) in NUMBERS]
        if isinstance(own, T.NullType) or (len(wider) == 2 and wider[0] < wider[1]):
            casts[c] = F.col(c).cast(old)
        elif len(wider) < 2 or c in keys:
            raise ValueError(f"{c} is {own.simpleString()} in the batch and {old.simpleString()} in the table")
    return batch.withColumns(casts) if casts else batch


def _merge_batch(store: Store, batch: DataFrame, keys: list[str], policy: Policy, batch_id: str | None, table: str, by: list[str]) -> int:
    values = [c for c in batch.columns if c not in ("op", "seq")]
    given = batch
    for attempt in range(ATTEMPTS):
        base = store.manifest()
        if store.has_batch(base, batch_id):
            return base["version"]
        batch = merged_types(store, base, table, given, keys)
        empty = batch.limit(0)
        hit = [r[0] for r in batch.select(bucket_of(keys, store.index_buckets)).distinct().collect()]  # index_buckets numbers at most
        index = index_table(store, base, empty, keys, hit)
        if policy.name == "update_strict" and not missing_keys(batch, index, keys).isEmpty():
            raise DataDelayed("keys of a strict update aren't there yet")
        acted = actions(batch, index, keys, policy).cache()
        try:
            applied = acted.where(F.col("action").isin(*APPLIED))
            touched = None
            if by:
                fresh = applied.where(F.col("action").isin("insert", "update")).select(*by)
                old = applied.where(F.col("action").isin("update", "delete") & F.col("x_live")).select(*[F.col(f"x_{c}").alias(c) for c in by])
                touched = part_keys(fresh.unionByName(old), by)
            target = empty.select(*values) if table not in base["tables"] else store.read(table, base=base, only=touched)
            after, new_index = apply(target, index, acted, keys, by, values)
            tables = {table: after, "index": with_bucket(new_index, store, keys)}
            seen = []

            def marks(m: dict) -> DataFrame:
                # counters are seen as the actions go by, without a job of their own
                frame, observation = observed(acted)
                seen.append(observation)
                return high_water_marks(frame, [], store.read("marks", base=m), policy)

            # marks only rise, so those of commits in between are taken in
            again = {"marks": marks}
            if by:
                again["partition_marks"] = lambda m: high_water_marks(acted, by, store.read("partition_marks", base=m), policy)
            parts = {"index": bucket_keys(hit)} | ({table: touched} if by else {})
            return store.commit(tables, parts, batch_id, base, by={"index": [BUCKET]}, sort={"index": keys} | ({table: keys} if by else {}), again=again, counts=lambda: {table: {k: n for k, n in seen[-1].get.items() if n}})
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
        finally:
            acted.unpersist()
    raise AssertionError("unreachable")


def merge_stream(
    stream: DataFrame, store: Store, keys: list[str], checkpoint: str, policy: Policy = COMBINED, prepare: Callable[[DataFrame], DataFrame] | None = None, every: str | None = None, pending: str | None = None
) -> StreamingQuery:
    """A query that merges each micro-batch; every: the trigger's interval, else all that is there and stop.

    pending: a folder for strict batches whose keys aren't there yet. After each micro-batch those that are due are
    tried again (see redrive_due).
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        try:
            merge_batch(store, rows, keys, policy, f"{checkpoint}#{batch_id}")
        except DataDelayed:
            if not pending:
                raise
            rows.write.mode("overwrite").parquet(f"{pending}/batch={batch_id}/attempt=0")
        if pending:
            redrive_due(store, pending, keys, policy)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def redrive(store: Store, pending: DataFrame, keys: list[str], policy: Policy, batch_id: str) -> bool:
    """Try a delayed batch again; whether it went in."""
    try:
        merge_batch(store, pending, keys, policy, batch_id)
    except DataDelayed:
        return False
    return True


def redrive_due(store: Store, pending: str, keys: list[str], policy: Policy, hours: float = DELAY_HOURS, attempts: int = MOST_ATTEMPTS) -> dict[str, bool]:
    """Try delayed batches again, oldest number first: those that are so old and were tried at most so often.

    A batch that goes in leaves the folder; for another an attempt is counted. Those with more attempts stay there
    for someone to look at. Returns what was tried and whether it went in.
    """
    spark, fs, path = store.spark, store._fs, store._path
    out = {}
    if not fs.exists(path(pending)):
        return out
    for status in sorted(fs.listStatus(path(pending)), key=lambda s: int(s.getPath().getName().rpartition("=")[2])):
        batch = status.getPath().toString()
        (at,) = [s for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("attempt=")]
        tried = int(at.getPath().getName().rpartition("=")[2])
        if tried > attempts or time.time() * 1000 - status.getModificationTime() < hours * 3_600_000:
            continue
        name = status.getPath().getName()
        out[name] = redrive(store, spark.read.parquet(at.getPath().toString()), keys, policy, f"{pending}/{name}")
        if out[name]:
            fs.delete(status.getPath(), True)
        else:
            fs.rename(at.getPath(), path(f"{batch}/attempt={tried + 1}"))
    return out

"""Keyed state of streams: versions of merged keys, and writers that flush by age or rows. State is kept in RocksDB.

A merge into a store looks its keys up in a stored index. Where only the changes are wanted, as a stream, the index can be
the stream's own state: an entry for each key, tombstones among them, kept by the checkpoint from one start to the next.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice
from operator import itemgetter
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cdclake.operators.envelope import CREATE, DELETE, UPDATE
from cdclake.operators.merge import APPLIED, COMBINED, Policy

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A writer's file is closed at so many rows, or so long after its first.
FILE_ROWS, FILE_MINUTES = 100_000, 5
#: Rows that a task sorts in memory; more are sorted so many at a time, and merged from its disk, so many runs at once.
SORT_ROWS, RUNS, READ_ROWS = 20_000, 32, 200
#: Rows that a task sends back at a time.
SENT_ROWS = 5000


def action_of(op: str, ut: int, entry: tuple[int, bool] | None, policy: Policy) -> str:
    """What a key's winner does, given the key's entry (ut, live) if it has one; see operators.merge.actions."""
    if policy.name == "combined":
        if entry is None:
            return "tombstone" if op == DELETE else "insert"
        if op == CREATE and not policy.create_as_upsert:
            return "skip_create"
        if ut < entry[0]:
            return "skip_late"
        if op == DELETE:
            return "delete"
        return "skip_late" if op == UPDATE and not entry[1] and not policy.resurrect else "update"
    if entry is None:
        return "skip_missing" if op == DELETE else "insert"
    if ut <= entry[0]:
        return "skip_late"
    return "delete" if op == DELETE else "update"


class Versions(StatefulProcessor):
    """One row for each key of a micro-batch: its winner, the action it takes, and the key's version after it."""

    def __init__(self, columns: list[str], policy: Policy):
        self.columns, self.policy = columns, policy
        self.row = Row(*columns, "x_ut", "x_live", "action", "version")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", "ut long, live boolean, version long")

    def known(self, op: str | None) -> str | None:
        if self.policy.name != "combined" or op in (CREATE, UPDATE, DELETE):
            return op
        if self.policy.on_unknown_op == "error":
            raise ValueError(f"unknown operation {op}")
        return CREATE if self.policy.on_unknown_op == "as_create" else None

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        best = None
        last = self.policy.name == "combined"  # of equal times the last to arrive, else the first
        for r in rows:  # one at a time: a hot key takes no memory
            op = self.known(r["op"])
            place = (r["ut"] or 0, r["seq"] if last else -r["seq"])
            if (op is not None or not last) and (best is None or place > best[0]):
                best = place, op, r
        if best is None:
            return
        (ut, _), op, r = best
        entry = tuple(self.entry.get()) if self.entry.exists() else None
        action = action_of(op, ut, entry[:2] if entry else None, self.policy)
        version = (entry[2] if entry else 0) + (action in APPLIED)
        if action in APPLIED:
            self.entry.update((ut, action in ("insert", "update"), version))
        values = [ut if c == "ut" else op if c == "op" else r[c] for c in self.columns]
        yield self.row(*values, entry[0] if entry else None, entry[1] if entry else None, action, version)

    def close(self) -> None:
        pass


def versioned(stream: DataFrame, keys: list[str], policy: Policy = COMBINED) -> DataFrame:
    """The changes that a stream of change rows (keys, op, ut, seq, values) makes: its columns, x_ut, x_live, action, version.

    Each micro-batch gives a row for each of its keys. Entries outlive deletes, so a change that comes late, in a later
    micro-batch or after a restart, is seen to be late. version counts the changes that were applied to the key. For
    the policies that fold a batch: combined and update_insert_missing.
    """
    if policy.name not in ("combined", "update_insert_missing"):
        raise ValueError(f"{policy.name} has no state of its own for each key")
    extra = "x_ut long, x_live boolean, action string, version long"
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in stream.schema], *T.StructType.fromDDL(extra).fields])
    return stream.groupBy(*keys).transformWithState(Versions(stream.columns, policy), schema, "Append", "None")


def live_rows(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that all changes so far leave: each key's last applied one, unless it deleted the key."""
    rest = [c for c in changes.columns if c not in keys and c != "version"]
    applied = changes.where(F.col("action").isin(*APPLIED))
    last = applied.groupBy(*keys).agg(F.max(F.struct("version", *[c for c in rest if c in ("ut", "seq")], *[c for c in rest if c not in ("ut", "seq")])).alias("_last"))
    return last.where(F.col("_last.action").isin("insert", "update")).select(*keys, *[f"_last.{c}" for c in rest if c not in ("op", "x_ut", "x_live", "action")])


def _spilled(rows: Iterable[tuple]) -> BinaryIO:
    """rows in a file on the task's disk that goes with it."""
    file, rows = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None), iter(rows)
    while some := list(islice(rows, READ_ROWS)):
        pickle.dump(some, file, pickle.HIGHEST_PROTOCOL)
    return file


def _read(file: BinaryIO) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            some = pickle.load(file)
        except EOFError:
            file.close()
            return
        yield from some


def in_order(rows: Iterable[tuple], key: Callable[[tuple], object], most: int = SORT_ROWS, runs: int = RUNS) -> Iterator[tuple]:
    """sorted(rows, key=key), in memory that doesn't grow with the rows."""
    rows, levels = iter(rows), [[]]  # runs of a level are merged from as many of the one before
    while part := sorted(islice(rows, most), key=key):
        if len(part) < most and levels == [[]]:
            yield from part
            return
        levels[0].append(_spilled(part))
        for k, level in enumerate(levels):
            if len(level) == runs:
                longer = _spilled(heapq.merge(*map(_read, level), key=key))
                level.clear()
                if k + 1 == len(levels):
                    levels.append([])
                levels[k + 1].append(longer)
    yield from heapq.merge(*map(_read, chain.from_iterable(reversed(levels))), key=key)


class Flushes(StatefulProcessor):
    """Rows (columns ms, place, packed) with the number of the file that their writer puts them into: packed and file, some at a time."""

    def __init__(self, most_rows: int, minutes: float):
        self.most_rows, self.age = most_rows, int(minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "file long, rows long, since long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        file, number, since = tuple(self.open.get()) if self.open.exists() else (0, 0, None)
        before = since
        given = (r for some in rows for r in zip(some["ms"].tolist(), some["place"].tolist(), some["packed"].tolist(), strict=True))
        ordered = in_order(given, itemgetter(0, 1))  # a writer's rows of one micro-batch
        while some := list(islice(ordered, SENT_ROWS)):
            files = []
            for at, _, _ in some:
                if number and (number >= self.most_rows or at - since >= self.age):
                    file, number = file + 1, 0
                if not number:
                    since = at
                number += 1
                files.append(file)
            yield pd.DataFrame({"packed": [values for _, _, values in some], "file": files})
        self.open.update((file, number, since))
        if since != before:
            if before is not None:
                self.handle.deleteTimer(before + self.age)
            self.handle.registerTimer(since + self.age)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        """The watermark is past the file's age: the next row opens another, whenever it comes."""
        file, number, since = tuple(self.open.get())
        if number:
            self.open.update((file + 1, 0, since))
        return iter(())

    def close(self) -> None:
        pass


def flushed(stream: DataFrame, writer: list[str], at: str, order: str, most_rows: int = FILE_ROWS, minutes: float = FILE_MINUTES, late: str = "0 seconds") -> DataFrame:
    """The rows of a stream with the number, from 0, of the file of their writer (columns writer) that they go into.

    A file takes rows in the order of `at` (a timestamp) and `order` (not null), until it has most_rows or a row comes that
    is `minutes` or more after its first. Timers close files whose writer falls silent. A micro-batch's rows of one writer
    are sorted in one task, SORT_ROWS of them in memory; those before the watermark, which is `late` behind, drop out.
    """
    columns = stream.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row's values travel as they are: through pandas, whole numbers beside nulls would turn into fractions
        for b in batches:
            values = zip(*[b.column(c).to_pylist() for c in columns], strict=True)
            packed = pa.array([pickle.dumps(v, pickle.HIGHEST_PROTOCOL) for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("_writer", "_at", "_ms", "_order")], packed], sent.names)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    arrow = to_arrow_schema(schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [pickle.loads(v) for v in b.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], b.column("file")], [*columns, "file"])

    whole = F.to_json(F.array(*[F.base64(w) if dict(stream.dtypes)[w] == "binary" else F.col(w).cast("string") for w in writer]))  # nulls are writers too
    timed = stream.withColumns({"_writer": whole, "_at": F.col(at).cast("timestamp"), "_order": F.col(order)}).withColumn("_ms", F.unix_millis("_at"))
    sent = T.StructType().add("writer", "string").add("at", "timestamp").add("ms", "long").add("place", schema[order].dataType).add("packed", "binary")
    marked = timed.mapInArrow(pack, sent).withWatermark("at", late)
    found = marked.groupBy("writer").transformWithStateInPandas(Flushes(most_rows, minutes), "packed binary, file long", "Append", "EventTime")
    return found.mapInArrow(unpack, T.StructType([*schema.fields, T.StructField("file", T.LongType())]))


def run_available(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Work through what a stream has, with its state in RocksDB, into Parquet files under path; a later call goes on from there."""
    conf = frame.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        query = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(PROVIDER, before) if before else conf.unset(PROVIDER)
    query.awaitTermination()
    return query

"""Staged files as tasks: a ledger in the store says which files wait, and merges work through it."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators import tasks
from cdclake.operators.merge import COMBINED, DataDelayed, Policy
from cdclake.sources import files
from cdclake.sources.store import Conflict, Store
from cdclake.streaming.merge import ATTEMPTS, merge_batch

LEDGER = "ledger"


def _commit(store: Store, change) -> None:
    """Publish change(ledger of a snapshot) as the ledger; again on a newer snapshot if another writer was first."""
    for attempt in range(ATTEMPTS):
        base = store.manifest()
        try:
            store.commit({LEDGER: change(store.read(LEDGER, base=base))}, base=base)
            return
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise


def publish(store: Store, rows: DataFrame, staging: str, db: str, table: str, op: str = "a", most_rows: int = 100_000) -> int:
    """Stage rows by the store's partitions and append a new task for each file; returns their number.

    Files of a stage whose tasks didn't get into the ledger belong to nobody, so a failed call can be made again.
    """
    listed = files.stage(rows, f"{staging}/{uuid.uuid4().hex}", store.by, most_rows)
    named = listed.select(F.lit(db).alias("db"), F.lit(table).alias("table_name"), "partition_name", "file_path", F.lit(op).alias("op"))
    made = store.spark.createDataFrame(tasks.new_tasks(named).collect(), tasks.new_tasks(named).schema)  # a row for each file of this stage
    _commit(store, lambda ledger: made if ledger is None else ledger.unionByName(made))
    return made.count()


def settle(store: Store, file: str, row, ok: bool, backup: str | None) -> None:
    """A merged file goes, or moves to the backup by operation, day, database and table; one that failed gets a name of its own."""
    path, fs = store._path, store._fs
    if not ok:
        fs.rename(path(file), path(f"{file}.error"))
    elif backup:
        folder = f"{backup}/{row.op}/{time.strftime('%Y/%m/%d')}/{row.db}/{row.table_name}"
        fs.mkdirs(path(folder))
        fs.rename(path(file), path(f"{folder}/{file.rsplit('/', 1)[1]}.processed"))
    else:
        fs.delete(path(file), False)


def consume(store: Store, keys: list[str], policy: Policy = COMBINED, limit: int = tasks.GREEDY, backup: str | None = None, delete: bool = False, delayed_hours: float | None = None) -> dict[str, int]:
    """Work through the ledger until no new task is left; returns how many tasks ended in which status.

    The first new task of a partition and up to limit more merge as one batch. Files that aren't there any more count
    as done. Batches that wait for keys get DELAY and an attempt more; others that fail get FAIL, and their files end
    in `.error`. delete: done tasks leave the ledger. delayed_hours: work through tasks that are so old and were
    delayed at most so often as operators.tasks says, instead of new ones. A batch that was merged before its tasks
    could be marked isn't merged again.
    """
    ended: dict[str, int] = defaultdict(int)
    tried: set[str] = set()
    while True:
        ledger = store.read(LEDGER)
        if ledger is None:
            return dict(ended)
        if delayed_hours is not None:
            due = tasks.delayed(ledger, F.current_timestamp(), delayed_hours).where(F.col("status") == tasks.DELAY)
        else:
            due = tasks.greedy(ledger, limit)
        groups = defaultdict(list)
        for row in due.orderBy("id").collect():  # limit + 1 tasks of each partition
            groups[row.db, row.table_name, row.partition_name].append(row)
        groups = {k: [r for r in own if r.id not in tried] for k, own in groups.items()}
        groups = {k: own for k, own in groups.items() if own}
        if not groups:
            return dict(ended)
        for own in groups.values():
            tried |= {r.id for r in own}
            there = [r.file_path for r in own if store._fs.exists(store._path(r.file_path))]
            status, ok = tasks.SUCCESS, True
            try:
                if there:
                    name = hashlib.md5(" ".join(sorted(r.id for r in own)).encode()).hexdigest()
                    merge_batch(store, files.staged(store.spark, *there), keys, policy, f"tasks-{name}")
            except DataDelayed:
                status, ok = tasks.DELAY, None
            except Exception:  # the tasks fail, others go on; the reason is in Spark's log
                status, ok = tasks.FAIL, False
            done = store.spark.createDataFrame([(r.id,) for r in own], "id string")
            _commit(store, lambda ledger, done=done, status=status: tasks.with_status(ledger, done, status, delete and status == tasks.SUCCESS))
            if ok is not None:
                for r in own:
                    if r.file_path in there:
                        settle(store, r.file_path, r, ok, backup)
            ended[status] += len(own)

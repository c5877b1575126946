"""Repair of a store's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdclake.operators import repair
from cdclake.operators.merge import index_of
from cdclake.sources.store import Store, part_keys
from cdclake.streaming.merge import commit_index, index_table


def remove_duplicates(store: Store, keys: list[str], newest: str, predicate: str | None = None, execute: bool = False, table: str = "rows") -> dict:
    """Keep the newest row of each key in the partitions that hold keys twice; rows of them without a key go.

    predicate chooses partitions. Without execute nothing changes. Returns the flagged partitions with their surplus,
    the version before, which stays readable as backup until it is vacuumed, and the version after. Rows, index and
    flags come from one snapshot, so a commit in between is a Conflict.
    """
    base = store.manifest()
    flagged = repair.duplicate_partitions(store.read(table, predicate=predicate, base=base), F.struct(*keys), store.by)
    found = [r.asDict() for r in flagged.orderBy(*store.by).collect()]  # a row for each partition
    out = {"partitions": found, "backup": base["version"], "version": base["version"]}
    if not found or not execute:
        return out
    parts = part_keys(flagged, store.by)
    rows = store.read(table, base=base, only=parts)
    order = [F.col(newest).desc(), *[F.col(c) for c in rows.columns if c not in keys and c != newest]]
    fixed = repair.ranked(rows, keys, order).where("rowno = 1").drop("rowno").cache()
    try:
        if not repair.validation(fixed, F.struct(*keys)).first().valid:
            raise RuntimeError("the repaired rows still hold duplicates")
        others = store.read(table, base=base, only=list(base["tables"][table].keys() - set(parts)))
        fresh = index_of(others.unionByName(fixed), keys, store.by)
        if "index" in base["tables"]:
            dead = index_table(store, base, fresh, keys).where("not live")
            fresh = fresh.unionByName(dead.join(fresh.select(*keys), keys, "left_anti"))
        out["version"] = commit_index(store, fresh, keys, base, {table: fixed}, {table: parts})
    finally:
        fixed.unpersist()
    return out

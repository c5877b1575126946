"""Winners of a batch and version-guarded merges, as DataFrame algebra.

A batch has key columns, `op`, `ut` (update time in ms) and `seq` (arrival order). The index has the key columns,
`ut` and `live`; entries outlive deletes, as tombstones. Winners are one row for each key before any join, by a
map-side-combinable aggregate, so a key with many events costs one row of shuffle for each map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cdclake.operators.envelope import CREATE, DELETE, UPDATE
from cdclake.operators.keyfilter import sifted


class DataDelayed(RuntimeError):
    """Keys of a strict update batch aren't there yet; nothing was applied."""


@dataclass(frozen=True)
class Policy:
    """M1 COMBINED by default; equal times are accepted there and rejected by the strict policies.

    check_exists: whether insert_only leaves known keys alone; without it every row is appended, known or not.
    """

    name: str = "combined"
    create_as_upsert: bool = False
    resurrect: bool = True
    on_unknown_op: str = "error"  # or skip, as_create
    check_exists: bool = True


COMBINED, UPDATE_STRICT, UPDATE_INSERT_MISSING, INSERT_ONLY = Policy(), Policy("update_strict"), Policy("update_insert_missing"), Policy("insert_only")


def winners(batch: DataFrame, keys: list[str], last_wins: bool = True) -> DataFrame:
    """The row of the greatest ut for each key; of equal ones the last to arrive, or the first."""
    rest = [c for c in batch.columns if c not in keys and c not in ("ut", "seq")]
    order = F.struct(F.coalesce("ut", F.lit(0)).alias("ut"), (F.col("seq") if last_wins else -F.col("seq")).alias("_order"), *rest, "seq")
    best = batch.groupBy(*keys).agg(F.max(order).alias("_best"))
    return best.select(*keys, "_best.ut", "_best.seq", *[f"_best.{c}" for c in rest])


def known_operations(batch: DataFrame, policy: Policy) -> DataFrame:
    known = F.col("op").isin(CREATE, UPDATE, DELETE)
    if policy.on_unknown_op == "skip":
        return batch.where(known)
    if policy.on_unknown_op == "as_create":
        return batch.withColumn("op", F.when(known, F.col("op")).otherwise(F.lit(CREATE)))
    bad = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(F.col("op"), F.lit("null"))))
    return batch.withColumn("op", F.when(known, F.col("op")).otherwise(bad.cast("string")))


def _guard(policy: Policy) -> Column:
    """Whether the batch row is too late for the index entry."""
    ut, at = F.col("ut"), F.col("x_ut")
    return (at.isNotNull() & (ut < at)) if policy.name == "combined" else (at.isNotNull() & (ut <= at))


def actions(batch: DataFrame, index: DataFrame, keys: list[str], policy: Policy = COMBINED) -> DataFrame:
    """Winners with x_ut, x_live (null: no entry) and the action that each takes.

    Actions: insert, update, delete, tombstone (delete of an unknown key), skip_create, skip_late, skip_missing.
    INSERT_ONLY keeps all rows of a key, as it does no folding. Further columns of the index come as x_<name>. An
    entry that doesn't say whether its row lives is corrupt and fails the job. Where INSERT_ONLY appends without asking
    (check_exists=False), the index isn't read.
    """
    if policy.name == "insert_only" and not policy.check_exists:
        unknown = [F.lit(None).cast(index.schema[c].dataType).alias(f"x_{c}") for c in index.columns if c not in keys]
        return batch.select("*", *unknown, F.lit("insert").alias("action"))
    if policy.name == "insert_only":
        rows = batch
    else:
        rows = winners(known_operations(batch, policy) if policy.name == "combined" else batch, keys, last_wins=policy.name == "combined")
    entries = index.select(*keys, *[F.col(c).alias(f"x_{c}") for c in index.columns if c not in keys], F.lit(True).alias("_there"))
    joined = rows.join(entries, keys, "left")
    there, op = F.col("_there").isNotNull(), F.col("op")
    joined = joined.withColumn("x_live", F.when(there & F.col("x_live").isNull(), F.raise_error(F.lit("corrupt index entry")).cast("boolean")).otherwise(F.col("x_live")))
    if policy.name == "insert_only":
        action = F.when(there, "skip_create").otherwise("insert")
    elif policy.name == "combined":
        dead = there & ~F.col("x_live") & F.lit(not policy.resurrect) & (op == UPDATE)
        action = (
            F.when(~there & (op == DELETE), "tombstone")
            .when(~there, "insert")
            .when((op == CREATE) & F.lit(not policy.create_as_upsert), "skip_create")
            .when(_guard(policy), "skip_late")
            .when(op == DELETE, "delete")
            .when(dead, "skip_late")
            .otherwise("update")
        )
    else:
        action = F.when(~there, F.when(op == DELETE, "skip_missing").otherwise("insert")).when(_guard(policy), "skip_late").when(op == DELETE, "delete").otherwise("update")
    return joined.withColumn("action", action).drop("_there")


def missing_keys(batch: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Winners of a strict batch whose key has no index entry."""
    return insert_if_absent(winners(batch, keys, last_wins=False), index, keys)


def insert_if_absent(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key the index doesn't have.

    Of the index, only entries that pass a filter of the rows' keys are shuffled: a batch's keys are few of them.
    """
    return rows.join(sifted(index.select(*keys), rows, keys), keys, "left_anti")


#: What counters() counts.
COUNTED = ("insert", "update", "delete", "skip_create", "skip_late", "skip_missing")


def counted_as() -> Column:
    """An update that inserts counts as an update, as does its tombstone as a delete."""
    return F.when(F.col("action") == "tombstone", "delete").when((F.col("action") == "insert") & (F.col("op") == UPDATE), "update").otherwise(F.col("action"))


def counters(acted: DataFrame) -> DataFrame:
    """(action, n); see counted_as."""
    return acted.groupBy(counted_as().alias("action")).agg(F.count(F.lit(1)).alias("n"))


def observed(acted: DataFrame) -> tuple[DataFrame, Observation]:
    """acted, and an observation of its counters, made by the first job that reads the frame as it goes by."""
    seen = Observation()
    return acted.observe(seen, *[F.count(F.when(counted_as() == name, 1)).alias(name) for name in COUNTED]), seen


APPLIED = ("insert", "update", "delete", "tombstone")


def apply(target: DataFrame, index: DataFrame, acted: DataFrame, keys: list[str], by: list[str] | None = None, values: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The target and the index after the actions. A row that changes its partition is rewritten there and leaves the old one.

    by: partition columns that the index keeps for each key, besides ut and live. values: columns of acted that the
    target shall have (its own, where not given). Those that the target lacks are null in its rows, those that acted
    lacks in the rows that it brings.
    """
    by = by or []
    touched = acted.where(F.col("action").isin(*APPLIED))
    gone = touched.where(F.col("action").isin("update", "delete")).select(*keys)
    fresh = touched.where(F.col("action").isin("insert", "update")).select(*(values or target.columns))
    after = target.join(gone, keys, "left_anti").unionByName(fresh, allowMissingColumns=True)
    last = F.max(F.struct("ut", *by))
    entries = touched.groupBy(*keys).agg(last.alias("_last"), F.max(F.col("action").isin("insert", "update")).alias("live"))
    entries = entries.select(*keys, "_last.ut", "live", *[f"_last.{c}" for c in by])
    kept = index.join(entries.select(*keys), keys, "left_anti").select(*keys, "ut", "live", *by)
    return after, kept.unionByName(entries)


def index_of(rows: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """A fresh index from rows: the greatest ut for each key, and its partition."""
    by = by or []
    best = rows.groupBy(*keys).agg(F.max(F.struct("ut", *by)).alias("_last"))
    return best.select(*keys, "_last.ut", F.lit(True).alias("live"), *[f"_last.{c}" for c in by])


def high_water_marks(acted: DataFrame, by: list[str], before: DataFrame | None = None, policy: Policy = COMBINED) -> DataFrame:
    """The greatest applied ut, by partition columns or for the whole table (no columns); never less than before.

    INSERT_ONLY counts the rows that it skips too.
    """
    counted = acted if policy.name == "insert_only" else acted.where(F.col("action").isin(*APPLIED))
    marks = counted.groupBy(*by).agg(F.max("ut").alias("mark"))
    if before is None:
        return marks
    return marks.unionByName(before).groupBy(*by).agg(F.max("mark").alias("mark"))

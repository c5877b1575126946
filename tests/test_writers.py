"""Writers of different partitions of one store don't stop each other; those of the same ones do."""

from __future__ import annotations

import pytest

import cdclake.streaming.merge as merge
from cdclake.sources.shared import new_path
from cdclake.sources.store import Conflict, Store
from cdclake.streaming.merge import merge_batch


def batch(spark, rows, more=""):
    return spark.createDataFrame(rows, "id long, op string, ut long, seq long, p int" + more)


class Between(Store):
    """A store in which something else commits just before each manifest that this one publishes, so many times."""

    def __init__(self, *args, other, times=1, **kwargs):
        super().__init__(*args, **kwargs)
        self.other, self.times, self.tries = other, times, 0

    def _publish_manifest(self, new):
        self.tries += 1
        if self.times:
            self.times -= 1
            self.other()
        return super()._publish_manifest(new)


def rows(store):
    return sorted((r.id, r.ut, r.p) for r in store.read("rows").collect())


def marks(store):
    return store.read("marks").first().mark, {r.p: r.mark for r in store.read("partition_marks").collect()}


@pytest.fixture
def store(spark):
    out = Store(spark, new_path(spark, "writers"), ["p"], index_buckets=64)
    merge_batch(out, batch(spark, [(k, "c", 1, k, k % 4) for k in range(40)]), ["id"])
    return out


def apart(spark, store):
    """Ids of two partitions that fall into different parts of the index."""
    found = {}
    for r in store.read("index").collect():
        found.setdefault(r["_bucket"], []).append(r)
    alone = [own[0] for own in found.values() if len(own) == 1]
    one = next(r for r in alone if r.p == 0)
    two = next(r for r in alone if r.p == 1)
    return one.id, two.id


def test_disjoint_merges_both_commit_at_once(spark, store, monkeypatch):
    a, b = apart(spark, store)
    monkeypatch.setattr(merge, "ATTEMPTS", 1)
    first = Between(spark, store.root, ["p"], index_buckets=64, other=lambda: merge_batch(store, batch(spark, [(b, "u", 9, 1, 1)]), ["id"], batch_id="b"))
    before = rows(store)
    merge_batch(first, batch(spark, [(a, "u", 7, 1, 0)]), ["id"], batch_id="a")
    assert first.tries == 2
    assert rows(store) == sorted([r for r in before if r[0] not in (a, b)] + [(a, 7, 0), (b, 9, 1)])
    assert marks(store) == (9, {0: 7, 1: 9, 2: 1, 3: 1})
    assert {"a", "b"} <= set(store.manifest()["batches"]) and store.read("index").count() == 40
    version = store.version()
    assert merge_batch(store, batch(spark, [(a, "u", 7, 1, 0)]), ["id"], batch_id="a") == version


@pytest.mark.parametrize("rows_of_other", ["same partition", "same key", "columns", "table"])
def test_overlapping_merges_conflict(spark, store, monkeypatch, rows_of_other):
    a, b = apart(spark, store)
    others = {
        "same partition": lambda: merge_batch(store, batch(spark, [(next(r[0] for r in rows(store) if r[2] == 0 and r[0] != a), "u", 5, 1, 0)]), ["id"]),
        "same key": lambda: merge_batch(store, batch(spark, [(a, "d", 5, 1, 0)]), ["id"]),
        "columns": lambda: merge_batch(store, batch(spark, [(b, "u", 5, 1, 1, "x")], ", more string"), ["id"]),
        "table": lambda: store.drop_partitions("rows", [(3,)]),
    }
    first = Between(spark, store.root, ["p"], index_buckets=64, other=others[rows_of_other])
    monkeypatch.setattr(merge, "ATTEMPTS", 1)
    with pytest.raises(Conflict):
        merge_batch(first, batch(spark, [(a, "u", 7, 1, 0)]), ["id"])
    monkeypatch.setattr(merge, "ATTEMPTS", 2)
    first.times = 0
    merge_batch(first, batch(spark, [(a, "u", 7, 1, 0)]), ["id"])
    assert (a, 7, 0) in rows(store)


def test_the_same_batch_twice_at_once(spark, store):
    a, b = apart(spark, store)
    one = batch(spark, [(a, "u", 7, 1, 0)])
    first = Between(spark, store.root, ["p"], index_buckets=64, other=lambda: merge_batch(store, one, ["id"], batch_id="x"))
    version = merge_batch(first, one, ["id"], batch_id="x")
    assert version == store.version() and store.manifest()["batches"].count("x") == 1


def test_whole_tables_still_conflict(spark, store):
    base = store.manifest()
    store.commit({"other": spark.range(1)})
    with pytest.raises(Conflict):
        store.commit({"third": spark.range(1)}, base=base)


def test_counters_take_no_job_of_their_own(spark, monkeypatch):
    def run():
        store = Store(spark, new_path(spark, "counters"), ["p"], index_buckets=4)
        scheduler = spark.sparkContext._jsc.sc().dagScheduler()
        merge_batch(store, batch(spark, [(k, "cud"[k % 3], 2, k, 0) for k in range(30)]), ["id"])
        before = scheduler.numTotalJobs()
        merge_batch(store, batch(spark, [(k, "cud"[k % 3], 1 + k % 2, k, 0) for k in range(20, 50)]), ["id"])
        return store, scheduler.numTotalJobs() - before

    store, jobs = run()
    assert store.manifest()["counters"]["rows"] == {"insert": 17, "update": 18, "delete": 18, "skip_create": 3, "skip_late": 4}

    class Nothing:
        get = {}

    monkeypatch.setattr(merge, "observed", lambda acted: (acted, Nothing))
    assert run()[1] == jobs


def test_counters_of_writers_add_up(spark, store):
    a, b = apart(spark, store)
    first = Between(spark, store.root, ["p"], index_buckets=64, other=lambda: merge_batch(store, batch(spark, [(b, "u", 9, 1, 1)]), ["id"]))
    merge_batch(first, batch(spark, [(a, "u", 7, 1, 0)]), ["id"])
    assert store.manifest()["counters"]["rows"] == {"insert": 40, "update": 2}

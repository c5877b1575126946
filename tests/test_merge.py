"""The merge state machine, row by row of its table and against a plain model."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cdclake.operators import merge as m
from cdclake.sources.store import Conflict, Store
from cdclake.streaming.merge import DataDelayed, merge_batch, redrive, redrive_due

BATCH = "k bigint, op string, ut bigint, seq bigint, v string"
INDEX = "k bigint, ut bigint, live boolean"


def batch(spark, *rows):
    return spark.createDataFrame([(k, op, ut, n, f"{op}{ut}") for n, (k, op, ut) in enumerate(rows)], BATCH)


def test_truth_table(spark):
    index = spark.createDataFrame([(k, 5, True) for k in range(10, 20)] + [(20, 5, False)], INDEX)
    given_rows = [(1, "c", 1), (2, "u", 1), (3, "d", 1), (10, "c", 9), (11, "u", 4), (12, "u", 5), (13, "u", 6), (14, "d", 4), (15, "d", 5), (20, "u", 6), (16, "u", None)]
    got = {r.k: r.action for r in m.actions(batch(spark, *given_rows), index, ["k"]).collect()}
    assert got == {1: "insert", 2: "insert", 3: "tombstone", 10: "skip_create", 11: "skip_late", 12: "update", 13: "update", 14: "skip_late", 15: "delete", 20: "update", 16: "skip_late"}
    stays = m.actions(batch(spark, (20, "u", 6)), index, ["k"], m.Policy(resurrect=False)).first().action
    assert stays == "skip_late"
    strict = {r.k: r.action for r in m.actions(batch(spark, (10, "c", 6), (11, "u", 5), (12, "d", 6), (1, "u", 1), (2, "d", 1)), index, ["k"], m.UPDATE_INSERT_MISSING).collect()}
    assert strict == {10: "update", 11: "skip_late", 12: "delete", 1: "insert", 2: "skip_missing"}


def test_ties(spark):
    b = batch(spark, (1, "c", 1), (1, "u", 2), (1, "d", 2))
    assert m.winners(b, ["k"]).first().op == "d"
    assert m.winners(b, ["k"], last_wins=False).first().op == "u"


def test_unknown_operation(spark):
    index = spark.createDataFrame([], INDEX)
    with pytest.raises(Exception, match="unknown operation"):
        m.actions(batch(spark, (1, "r", 1)), index, ["k"]).collect()
    assert m.actions(batch(spark, (1, "r", 1)), index, ["k"], m.Policy(on_unknown_op="skip")).count() == 0
    assert m.actions(batch(spark, (1, "r", 1)), index, ["k"], m.Policy(on_unknown_op="as_create")).first().action == "insert"


def model(rows, index, events):
    best = {}
    for n, (k, op, ut) in enumerate(events):
        if k not in best or ut >= best[k][1]:
            best[k] = (op, ut)
    for k, (op, ut) in best.items():
        if k not in index:
            index[k] = ut
            if op != "d":
                rows[k] = f"{op}{ut}"
        elif op != "c" and ut >= index[k]:
            index[k] = ut
            rows.pop(k, None)
            if op == "u":
                rows[k] = f"{op}{ut}"


event = st.tuples(st.integers(1, 4), st.sampled_from("cud"), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(event, min_size=1, max_size=8), min_size=1, max_size=2))
def test_against_model(spark, batches):
    rows, index = {}, {}
    target, entries = spark.createDataFrame([], "k bigint, ut bigint, v string"), spark.createDataFrame([], INDEX)
    for events in batches:
        model(rows, index, events)
        target, entries = m.apply(target, entries, m.actions(batch(spark, *events), entries, ["k"]), ["k"])
    assert {r.k: r.v for r in target.collect()} == rows
    assert {r.k: r.ut for r in entries.collect()} == index


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", by=["p"])
    rows = lambda *r: spark.createDataFrame([(k, op, ut, n, p) for n, (k, op, ut, p) in enumerate(r)], "k bigint, op string, ut bigint, seq bigint, p int")
    merge_batch(store, rows((1, "c", 1, 1), (2, "c", 1, 2), (3, "c", 1, None)), ["k"], batch_id="a")
    assert merge_batch(store, rows((1, "c", 1, 1)), ["k"], batch_id="a") == 1
    untouched = {k: v for k, v in store.manifest()["tables"]["rows"].items() if k == '["2"]'}
    merge_batch(store, rows((1, "u", 2, 7), (4, "d", 1, 1)), ["k"], batch_id="b")  # key 1 moves to another partition
    assert sorted((r.k, r.p or 0) for r in store.read("rows").collect()) == [(1, 7), (2, 2), (3, 0)]
    assert untouched.items() <= store.manifest()["tables"]["rows"].items()
    assert {r.k: r.live for r in store.read("index").collect()} == {1: True, 2: True, 3: True, 4: False}
    assert store.read("marks").first().mark == 2
    with pytest.raises(Conflict):
        store.commit({}, base=store.manifest(1))
    with pytest.raises(DataDelayed):
        merge_batch(store, rows((9, "u", 3, 1)), ["k"], m.UPDATE_STRICT)
    assert not redrive(store, rows((9, "u", 3, 1)), ["k"], m.UPDATE_STRICT, "c")
    before = sorted(map(tuple, store.read("rows").collect()), key=str)
    store.compact("rows", more_than=0)
    assert sorted(map(tuple, store.read("rows").collect()), key=str) == before
    assert not store.vacuum(keep=2)  # young folders may belong to a commit that isn't published yet
    assert store.vacuum(grace_seconds=0) and sorted(map(tuple, store.read("rows").collect()), key=str) == before
    store.drop_partitions("rows", [(7,)])
    assert sorted(r.k for r in store.read("rows").collect()) == [2, 3]


def of_orders(spark, *r):
    return spark.createDataFrame([(k, op, ut, n, p) for n, (k, op, ut, p) in enumerate(r)], "k bigint, op string, ut bigint, seq bigint, p string")


def test_two_writers_at_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", by=["p"])
    merge_batch(store, of_orders(spark, (1, "c", 1, "a")), ["k"])
    base = store.manifest()
    from concurrent.futures import ThreadPoolExecutor

    def write(n):
        try:
            return store.commit({f"t{n}": spark.range(n)}, base=base)
        except Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        done = [v for v in pool.map(write, range(1, 7)) if v]
    assert done == [base["version"] + 1] and len(store.manifest()["tables"]) == len(base["tables"]) + 1


def test_names_that_may_be_replaced_need_a_publisher(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store._fs = type("Fs", (), {"getUri": lambda self: type("U", (), {"getScheme": lambda self: "s3a"})()})()
    with pytest.raises(ValueError, match="publish"):
        store._take_name("a", "b")
    taken = []
    own = Store(spark, f"file://{tmp_path}", publish=lambda aside, path: taken.append(path) or False)
    with pytest.raises(Conflict):
        own.commit({"t": spark.range(1)})
    assert taken and own.version() == 0


def test_compaction_beside_a_merge(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}", by=["p"])
    merge_batch(store, of_orders(spark, (1, "c", 1, "a"), (2, "c", 1, "a")), ["k"])
    commit = Store.commit

    def late(self, *a, **b):
        monkeypatch.setattr(Store, "commit", commit)
        merge_batch(self, of_orders(spark, (3, "c", 1, "a")), ["k"])
        return commit(self, *a, **b)

    monkeypatch.setattr(Store, "commit", late)
    with pytest.raises(Conflict):
        store.compact("rows", more_than=0)
    assert sorted(r.k for r in store.read("rows").collect()) == [1, 2, 3]


def test_one_row_touches_one_partition_and_one_bucket(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", by=["p"], index_buckets=8)
    merge_batch(store, of_orders(spark, *[(k, "c", 1, f"it's {k % 5}") for k in range(40)]), ["k"])
    before = store.manifest()["tables"]
    merge_batch(store, of_orders(spark, (7, "u", 2, "it's 2")), ["k"])
    after = store.manifest()["tables"]
    assert sum(after["rows"][k] != before["rows"][k] for k in before["rows"]) == 1
    assert sum(after["index"][k] != before["index"][k] for k in before["index"]) == 1
    pruned = store.read("rows", predicate="p = 'it\\'s 2'")
    assert len({f.rsplit("/", 1)[0] for f in pruned.inputFiles()}) == 1 and pruned.count() == 8
    assert {r.mark for r in store.read("partition_marks").where("p = 'it\\'s 2'").collect()} == {2}
    moved = of_orders(spark, (7, "u", 3, "elsewhere"))
    merge_batch(store, moved, ["k"])
    assert [r.p for r in store.read("rows").where("k = 7").collect()] == ["elsewhere"]
    assert store.read("rows", predicate="k = 7").count() == 1  # no partition column: nothing to prune by


def test_streams_are_remembered_by_their_last_batch(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    for n in range(3):
        merge_batch(store, batch(spark, (n, "c", 1)), ["k"], batch_id=f"s#{n}")
    assert store.manifest()["streams"] == {"s": 2} and store.manifest()["batches"] == []
    assert merge_batch(store, batch(spark, (9, "c", 1)), ["k"], batch_id="s#1") == 3
    assert sorted(r.k for r in store.read("rows").collect()) == [0, 1, 2]


def test_insert_only_without_looking(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    blind = m.Policy("insert_only", check_exists=False)
    for _ in range(2):
        merge_batch(store, batch(spark, (1, "c", 1), (1, "c", 2)), ["k"], blind)
    assert sorted(r.ut for r in store.read("rows").collect()) == [1, 1, 2, 2]
    assert [(r.k, r.ut) for r in store.read("index").collect()] == [(1, 2)]


def test_corrupt_index_entry(spark):
    index = spark.createDataFrame([(1, 5, None)], INDEX)
    with pytest.raises(Exception, match="corrupt index entry"):
        m.actions(batch(spark, (1, "u", 6)), index, ["k"]).collect()


def test_redrive(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    pending = f"file://{tmp_path}/pending"
    assert redrive_due(store, pending, ["k"], m.UPDATE_STRICT) == {}
    batch(spark, (1, "u", 5)).write.parquet(f"{pending}/batch=0/attempt=0")
    assert redrive_due(store, pending, ["k"], m.UPDATE_STRICT) == {}  # too young
    for n in range(3):
        assert redrive_due(store, pending, ["k"], m.UPDATE_STRICT, hours=0, attempts=2) == {"batch=0": False}, n
    assert redrive_due(store, pending, ["k"], m.UPDATE_STRICT, hours=0, attempts=2) == {}  # tried often enough
    merge_batch(store, batch(spark, (1, "c", 1)), ["k"])
    assert redrive_due(store, pending, ["k"], m.UPDATE_STRICT, hours=0) == {"batch=0": True}
    assert store.read("rows").first().ut == 5 and redrive_due(store, pending, ["k"], m.UPDATE_STRICT, hours=0) == {}

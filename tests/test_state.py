"""Keyed state of streams: late changes after restarts, hot keys, policies, and files that age or fill."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from cdclake.operators import merge as m
from cdclake.sources.files import staged_stream
from cdclake.sources.shared import new_path
from cdclake.sources.store import Store
from cdclake.streaming.marks import marks_stream, raise_marks
from cdclake.streaming.state import action_of, flushed, live_rows, run_available, versioned

CHANGES = "k long, op string, ut long, seq long, v string"


def feed(spark, parts, policy=m.COMBINED):
    """The changes that each part makes, in a start of the stream of its own."""
    folder = new_path(spark, "state")
    for rows in parts:
        spark.createDataFrame(rows, CHANGES).write.mode("append").parquet(f"{folder}/in")
        stream = staged_stream(spark, f"{folder}/in", spark.createDataFrame([], CHANGES).schema)
        run_available(versioned(stream, ["k"], policy), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out")


def test_versions_through_restarts(spark):
    got = feed(spark, [
        [(1, "c", 5, 1, "a"), (1, "u", 7, 2, "b"), (2, "d", 5, 3, None), (3, "c", 1, 4, "x"), (3, "u", 1, 5, "y")],
        [(1, "u", 6, 6, "late"), (2, "u", 4, 7, "late"), (3, "d", 2, 8, None)],
        [(2, "u", 6, 9, "back"), (3, "u", 1, 10, "late"), (1, "c", 9, 11, "again"), (4, "u", None, 12, "new")],
    ])
    seen = sorted((r.seq, r.k, r.action, r.x_ut, r.version) for r in got.collect())
    assert seen == [(2, 1, "insert", None, 1), (3, 2, "tombstone", None, 1), (5, 3, "insert", None, 1), (6, 1, "skip_late", 7, 1), (7, 2, "skip_late", 5, 1), (8, 3, "delete", 1, 2), (9, 2, "update", 5, 2), (10, 3, "skip_late", 2, 2), (11, 1, "skip_create", 7, 1), (12, 4, "insert", None, 1)]
    assert {(r.k, r.ut, r.v) for r in live_rows(got, ["k"]).collect()} == {(1, 7, "b"), (2, 6, "back"), (4, 0, "new")}


def test_a_hot_key_and_first_wins(spark):
    rows = [(1, "u", k % 100, k, str(k)) for k in range(20_000)] + [(k, "u", 1, 20_000 + k, "x") for k in range(2, 30)]
    for policy, seq in ((m.COMBINED, 19_999), (m.UPDATE_INSERT_MISSING, 99)):
        (hot,) = feed(spark, [rows], policy).where("k = 1").collect()
        assert (hot.ut, hot.seq, hot.action) == (99, seq, "insert")


def test_unknown_operations(spark):
    with pytest.raises(StreamingQueryException):
        feed(spark, [[(1, "z", 1, 1, "a")]])
    assert feed(spark, [[(1, "z", 1, 1, "a"), (2, "c", 1, 2, "b")]], m.Policy(on_unknown_op="skip")).count() == 1
    assert feed(spark, [[(1, "z", 1, 1, "a")]], m.Policy(on_unknown_op="as_create")).first().action == "insert"
    with pytest.raises(ValueError, match="state"):
        versioned(spark.createDataFrame([], CHANGES), ["k"], m.INSERT_ONLY)


def test_actions_are_those_of_a_batch(spark):
    """action_of and operators.merge.actions agree on every case."""
    cases = [(op, ut, entry) for op in "cud" for ut in (1, 2, 3) for entry in (None, (2, True), (2, False))]
    for policy in (m.COMBINED, m.Policy(create_as_upsert=True), m.Policy(resurrect=False), m.UPDATE_INSERT_MISSING):
        batch = spark.createDataFrame([(k, op, ut, k) for k, (op, ut, _) in enumerate(cases)], "k int, op string, ut long, seq int")
        index = spark.createDataFrame([(k, *e) for k, (_, _, e) in enumerate(cases) if e], "k int, ut long, live boolean")
        got = {r.k: r.action for r in m.actions(batch, index, ["k"], policy).collect()}
        assert got == {k: action_of(*case, policy) for k, case in enumerate(cases)}


def test_files_age_and_fill(spark):
    """Rows and restarts as they come; a writer's files don't depend on where the stream was cut."""
    start = dt.datetime(2024, 1, 1)
    minutes = {"a": [0, 1, 2, 3, 4, 30, 31, 41, 42], "b": [0, 9, 10, 19, 20, 40], "c": [50]}
    rows = sorted((t, w, 10 * t + k) for k, w in enumerate(minutes) for t in minutes[w])

    def run(cuts):
        folder = new_path(spark, "files")
        for low, high in zip([0, *cuts], [*cuts, 99]):
            part = [(i, w, start + dt.timedelta(minutes=t)) for t, w, i in rows if low <= t < high]
            spark.createDataFrame(part, "id long, w string, ts timestamp").write.mode("append").parquet(f"{folder}/in")
            stream = staged_stream(spark, f"{folder}/in", spark.createDataFrame([], "id long, w string, ts timestamp").schema)
            run_available(flushed(stream, ["w"], "ts", "id", most_rows=3, minutes=10), f"{folder}/out", f"{folder}/checkpoint")
        out = spark.read.parquet(f"{folder}/out").orderBy("w", "ts").collect()
        return {w: [r.file for r in out if r.w == w] for w in minutes}

    expected = {"a": [0, 0, 0, 1, 1, 2, 2, 3, 3], "b": [0, 0, 1, 1, 2, 3], "c": [0]}
    assert run([]) == expected
    assert run([5, 20, 35]) == expected


def test_marks_never_go_back(spark):
    """Late and repeated micro-batches, a restart, and changes that the watermark has passed."""
    day = 86_400_000
    store, folder = Store(spark, new_path(spark, "marks")), new_path(spark, "marks-stream")
    schema = "p int, ut long, action string"

    def run(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(f"{folder}/in")
        stream = staged_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
        marks_stream(stream, store, ["p"], f"{folder}/checkpoint", late="2 days").awaitTermination()
        return {r.p: r.mark for r in store.read("stream_marks").collect()}

    assert run((1, 10 * day, "insert"), (2, 10 * day + 5, "update"), (2, 11 * day, "skip_late"), (None, 9 * day, "tombstone")) == {1: 10 * day, 2: 10 * day + 5, None: 9 * day}
    assert run((1, 9 * day, "update"), (2, 10 * day + 5, "update")) == {1: 10 * day, 2: 10 * day + 5, None: 9 * day}
    assert run((1, 20 * day, "delete"), (3, day, "insert"))[1] == 20 * day
    assert run((1, 2 * day, "insert"), (2, 19 * day, "insert")) | {3: 0} == {1: 20 * day, 2: 19 * day, None: 9 * day, 3: 0}
    version = raise_marks(store, spark.createDataFrame([(1, 5)], "p int, mark long"), ["p"], "again")
    assert raise_marks(store, spark.createDataFrame([(1, 99 * day)], "p int, mark long"), ["p"], "again") == version
    assert store.read("stream_marks").where("p = 1").first().mark == 20 * day

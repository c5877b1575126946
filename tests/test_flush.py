"""Files of a batch's writers against a loop over their rows; writers of one row to very many, dealt over many tasks."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from cdclake.operators import flush
from cdclake.operators.flush import flushed_batch
from cdclake.sources.shared import written

START = dt.datetime(2024, 1, 1)


def brute(rows, most_rows, minutes):
    out, open_ = {}, {}
    for i, w, at in sorted(rows, key=lambda r: (r[2], r[0])):
        file, n, since = open_.get(w, (0, 0, None))
        if n and (n >= most_rows or (at - since).total_seconds() >= minutes * 60):
            file, n = file + 1, 0
        open_[w] = file, n + 1, at if not n else since
        out[i] = file
    return out


@pytest.mark.parametrize("most_rows, minutes, task_rows", [(7, 10, 300), (1, 10, 10_000), (10_000, 3, 500), (10_000, 10_000, 300)])
def test_flushed_batch(spark, most_rows, minutes, task_rows):
    rng = random.Random(most_rows)
    sizes = {"one": 1, "two": 2, "hot": 1500, None: 40, "": 30}  # the hot one takes several tasks
    rows = [(w, START + dt.timedelta(seconds=rng.choice([0, 60, 600]) + rng.randrange(n * 40))) for w, n in sizes.items() for _ in range(n)]
    rows = [(i, w, at) for i, (w, at) in enumerate(rows)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, w string, ts timestamp").repartition(3)
    got = flushed_batch(frame, ["w"], "ts", "id", most_rows, minutes, task_rows)
    assert got.columns == ["id", "w", "ts", "file"]
    assert {r.id: r.file for r in got.collect()} == brute(rows, most_rows, minutes)


def test_empty(spark):
    assert flushed_batch(spark.createDataFrame([], "id long, w string, ts timestamp"), ["w"], "ts", "id", 5, 5).count() == 0


@pytest.mark.parametrize("most_rows, minutes", [(1, 10), (6, 10), (150, 0.5), (10_000, 4)])
def test_writers_of_many_blocks(spark, most_rows, minutes):
    """Blocks of 40 rows, which files end in, fill and go beyond; writers of two columns."""
    rng = random.Random(most_rows)
    rows = []
    for w, n in {("a", 1): 900, ("a", None): 400, (None, None): 41, ("b", 1): 40, ("b", 2): 1}.items():
        at = START
        for _ in range(n):
            at += dt.timedelta(seconds=rng.choice([0, 0, 1, 5, 90]))
            rows.append((len(rows), *w, at))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, w string, v int, ts timestamp").repartition(4)
    got = flushed_batch(frame, ["w", "v"], "ts", "id", most_rows, minutes, 40)
    assert {r.id: r.file for r in got.collect()} == brute([(i, (w, v), at) for i, w, v, at in rows], most_rows, minutes)


def test_no_writer_columns(spark):
    rows = [(i, START + dt.timedelta(seconds=7 * i)) for i in range(500)]
    got = flushed_batch(spark.createDataFrame(rows, "id long, ts timestamp"), [], "ts", "id", 9, 1, 60)
    assert {r.id: r.file for r in got.collect()} == brute([(i, 0, at) for i, at in rows], 9, 1)


def test_written_rows_grow_as_the_batch_does(spark, monkeypatch):
    """However many files a writer has, each row is written a fixed number of times."""
    counts = []

    def counted(frame, name):
        out = written(frame, name)
        counts.append(out.count())
        return out

    monkeypatch.setattr(flush, "written", counted)
    rows = [(i, "w", START + dt.timedelta(seconds=i)) for i in range(4000)]
    assert flushed_batch(spark.createDataFrame(rows, "id long, w string, ts timestamp"), ["w"], "ts", "id", 1, 10, 500).count() == 4000
    assert sum(counts) <= 4 * 4000

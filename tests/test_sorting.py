"""A writer's rows of one micro-batch are sorted in memory that doesn't grow with them."""

from __future__ import annotations

import datetime as dt
import random
import tracemalloc
from decimal import Decimal
from operator import itemgetter

import pandas as pd
import pytest

from cdclake.streaming.state import Flushes, flushed, in_order, run_available


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 30, 31, 299, 1000])
def test_in_order(n):
    rng = random.Random(n)
    rows = [(rng.randrange(50), None, k) for k in range(n)]  # equal ones stay as they come
    assert list(in_order(iter(rows), itemgetter(0), most=10, runs=3)) == sorted(rows, key=itemgetter(0))


class State:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    def getValueState(self, name, schema):
        return State()

    def registerTimer(self, at):
        pass


def test_memory_of_a_hot_writer():
    n = 200_000
    flushes = Flushes(7, 10**9)
    flushes.init(Handle())
    tracemalloc.start()
    try:
        got = 0
        given = (pd.DataFrame({"ms": range(k, k - 1000, -1), "place": range(k, k - 1000, -1), "packed": [b"%d" % j for j in range(k, k - 1000, -1)]}) for k in range(n, 0, -1000))
        for some in flushes.handleInputRows(("w",), given, None):
            assert len(some) <= 5000
            assert some["packed"].tolist() == [b"%d" % j for j in range(got + 1, got + 1 + len(some))]
            assert some["file"].tolist() == [j // 7 for j in range(got, got + len(some))]
            got += len(some)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == n
    assert peak < 24 << 20


def test_values_and_writers_of_any_type(spark, tmp_path):
    """Nulls beside whole numbers beyond a double's, fractions that are no number, writers of null and empty text."""
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = [(k, w, v, (1 << 62) + k if k % 2 else None, float("nan") if k % 3 else None, at + dt.timedelta(minutes=k), [k, None], Decimal(k)) for k, (w, v) in enumerate([(None, 1), ("", None), (None, 1), ("null", None), (None, None), ("", None)])]
    frame = spark.createDataFrame(rows, "id long, w string, v int, big long, x double, ts timestamp, l array<int>, d decimal(9,2)")
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    run_available(flushed(stream, ["w", "v"], "ts", "id", most_rows=1, minutes=10), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.columns == [*frame.columns, "file"]
    assert [repr(tuple(r)[:-1]) for r in got.orderBy("id").collect()] == [repr(tuple(r)) for r in frame.orderBy("id").collect()]
    assert [r.file for r in got.orderBy("id").collect()] == [0, 0, 1, 0, 0, 1]

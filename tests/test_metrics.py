"""Quantiles of latencies against sorted lists."""

from __future__ import annotations

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from cdclake.operators.metrics import operation_metrics

RANKS = (0.5, 0.9, 0.99)


def test_quantiles_are_exact(spark):
    rng = random.Random(5)
    of = {
        ("a", None): [rng.gauss(0, 1) for _ in range(60_000)],  # more than an approximation tells apart
        (None, 1): [float(rng.choice([3, 3, 3, 7])) for _ in range(5_000)],
        ("a", 1): [float(k) for k in range(100)],
        ("", 1): [2.5, None],
        ("b", None): [None, None],
        ("c", 2): [float("nan"), 1.0, float("inf")],
    }
    rows = [(*label, x) for label, xs in of.items() for x in xs]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "kind string, node int, ms double").repartition(5)
    got = {(r.kind, r.node): r for r in operation_metrics(frame, ["kind", "node"], latency="ms").collect()}
    assert got.keys() == of.keys()
    for label, xs in of.items():
        there = sorted((x for x in xs if x is not None), key=lambda x: (math.isnan(x), x))
        expected = [there[math.ceil(Fraction(str(q)) * len(there)) - 1] for q in RANKS] if there else None
        assert got[label].n == len(xs)
        assert repr(got[label].latency) == repr(expected)


def test_no_rows(spark):
    assert operation_metrics(spark.createDataFrame([], "kind string, ms double"), ["kind"], latency="ms").count() == 0


def test_quantiles_of_all_rows(spark):
    """No labels: one row."""
    frame = spark.range(1, 30_001).select((30_001 - F.col("id")).alias("ms"))
    got = operation_metrics(frame, [], latency="ms").collect()
    assert [(r.n, r.latency) for r in got] == [(30_000, [15_000, 27_000, 29_700])]

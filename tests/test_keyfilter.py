"""The key filter: loses no key, lets as few others through as it says, and leaves joins as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cdclake.operators.keyfilter import WORDS, error_rate, key_filter, sifted, with_maybe
from cdclake.operators.merge import insert_if_absent, missing_keys


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("text"))


@pytest.mark.parametrize("n", [0, 1, 500, 50_000])
def test_no_key_is_lost(spark, n):
    rows = numbers(spark, 50_000)
    got = with_maybe(rows, key_filter(rows.limit(0) if not n else numbers(spark, n), "k", "text"), "k", "text")
    assert got.columns == ["k", "text", "_maybe"] and got.count() == 50_000
    assert got.where("_maybe and coalesce(k, 0) < " + str(n)).count() == n


@pytest.mark.parametrize("n", [100_000, 2_000_000])
def test_error_rate(spark, n):
    passed = sifted(numbers(spark, 100_000, start=10_000_000), numbers(spark, n), ["k"]).count()
    expected = 100_000 * error_rate(n)
    assert abs(passed - expected) < 6 * expected**0.5 + 10
    assert key_filter(numbers(spark, n), "k").count() <= WORDS


def test_error_rate_grows_to_one():
    rates = [error_rate(n) for n in (0, 10**5, 10**6, 10**7, 10**8, 10**10)]
    assert rates[0] == 0 and rates == sorted(rates) and rates[-1] == 1 and rates[2] < 0.01


def test_insert_if_absent(spark):
    """The index's rows that meet the batch are those of its keys and a few more."""
    rows, index = numbers(spark, 300, start=900), numbers(spark, 20_000).withColumn("ut", F.lit(1)).where("k % 3 <> 0")
    got = {r.k for r in insert_if_absent(rows, index, ["k"]).collect()}
    assert got == {k for k in range(900, 1200) if k % 3 == 0}
    past = sifted(index.select("k"), rows, ["k"]).count()
    assert 200 <= past <= 200 + 20_000 * 0.001
    assert insert_if_absent(rows.limit(0), index, ["k"]).count() == 0 and insert_if_absent(rows, index.limit(0), ["k"]).count() == 300
    nulls = spark.createDataFrame([(None,), (1,)], "k long")
    assert [r.k for r in insert_if_absent(nulls, spark.createDataFrame([(1,), (None,)], "k long"), ["k"]).collect()] == [None]  # null equals none in a join


def test_missing_keys(spark):
    batch = spark.createDataFrame([(1, "u", 1, 1), (1, "u", 2, 2), (2, "u", 1, 3)], "k long, op string, ut long, seq long")
    assert [tuple(r)[:3] for r in missing_keys(batch, spark.createDataFrame([(2,)], "k long"), ["k"]).select("k", "ut", "seq").collect()] == [(1, 2, 2)]

"""The index in buckets: no exchange above it at any size, and none with other buckets than it was written with."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cdclake.sources.bucketed import BucketedIndex, after
from cdclake.sources.shared import new_path
from cdclake.sources.store import Conflict, Store


def batch(spark, n, start=0, ut=1, op="c"):
    return spark.range(start, start + n).select("id", F.lit(op).alias("op"), F.lit(ut).cast("long").alias("ut"), F.col("id").alias("seq"))


def above_scan(frame):
    """The nodes of the plan between its root and the scan in buckets."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[ :+\\-]*", x)[0]) for x in lines]
    (scan,) = [k for k, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x]
    path, d = [], depth[scan]
    for k in range(scan - 1, -1, -1):
        if depth[k] < d:
            path.append(lines[k].strip(" :+-"))
            d = depth[k]
    return path


@pytest.fixture
def planner(spark):
    """Plans as for tables that are too large to be broadcast."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("n", [50, 20_000])
def test_the_index_does_not_move(spark, planner, n):
    index = BucketedIndex(Store(spark, new_path(spark, "buckets")), ["id"], 8)
    index.merge(batch(spark, n))
    acted = index.actions(batch(spark, n, start=n // 2, ut=2, op="u"))
    path = above_scan(acted)
    assert any("Join" in x for x in path) and not any("Exchange" in x for x in path)
    fresh = batch(spark, n, start=n // 2).select("id", "ut", F.lit(True).alias("live"))
    path = above_scan(after(index.read(), fresh, ["id"], 8).repartition(8, "id"))  # as it is written
    assert any("Join" in x for x in path) and not any("Exchange" in x for x in path)
    assert len(index.read().inputFiles()) <= 8
    counts = {r.action: r.n for r in acted.groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert counts == {"update": n - n // 2, "insert": n // 2}


def test_other_buckets_are_refused(spark):
    store = Store(spark, new_path(spark, "stale"))
    index = BucketedIndex(store, ["id"], 4)
    index.merge(batch(spark, 10))
    for other in (BucketedIndex(store, ["id"], 8), BucketedIndex(store, ["ut"], 4)):
        with pytest.raises(ValueError, match="bucketed_index is in the store as"):
            other.merge(batch(spark, 10))
    assert index.read().count() == 10


def test_another_session_and_versions(spark):
    """A table that this session doesn't know is read from the manifest; old versions stay readable."""
    store = Store(spark, new_path(spark, "versions"))
    index = BucketedIndex(store, ["id"], 4)
    index.merge(batch(spark, 10), batch_id="a")
    old = store.manifest()
    index.merge(batch(spark, 3, ut=2, op="d"), batch_id="b")
    assert index.merge(batch(spark, 3, ut=3, op="u"), batch_id="b").count() == 0
    for t in spark.catalog.listTables():
        if t.name.startswith("cdclake_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert index.read().where("not live").count() == 3 and index.read(old).where("live").count() == 10
    with pytest.raises(Conflict):
        index.write(index.read(old), old)
    assert index.actions(batch(spark, 0)).count() == 0

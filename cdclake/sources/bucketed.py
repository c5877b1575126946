"""An index in buckets that the planner knows: joins by its keys move the batch alone, never the index.

A bucket is the rows whose keys have one hash (Spark's own, modulo the number of buckets), in one file sorted by key. The
join of a batch reads each bucket in a task of its own and sends the batch's rows there; the index after the merge comes
out in the same buckets and is written from where it is. Versions are published by the store's manifests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators.merge import APPLIED, COMBINED, Policy, actions
from cdclake.sources.shared import new_path
from cdclake.sources.store import Store


class BucketedIndex:
    """The index of keys (keys, ut, live and more) in so many buckets; a store holds it as one table."""

    def __init__(self, store: Store, keys: list[str], buckets: int, table: str = "bucketed_index"):
        self.store, self.keys, self.buckets, self.table = store, keys, buckets, table

    def _spec(self) -> dict:
        return {"keys": self.keys, "buckets": self.buckets}

    def read(self, base: dict | None = None) -> DataFrame | None:
        """The index of a snapshot, None if there is none. One that was written with other keys or buckets is refused."""
        spark, base = self.store.spark, base or self.store.manifest()
        if self.table not in base["tables"]:
            return None
        spec = base.get("buckets", {}).get(self.table)
        if spec != self._spec():
            raise ValueError(f"{self.table} is in the store as {spec}, not {self._spec()}")
        (folder,) = base["tables"][self.table].values()
        name = f"cdclake_{folder.rsplit('/', 1)[1]}"
        if not spark.catalog.tableExists(name):
            keys = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(f"CREATE TABLE {name} ({base['schemas'][self.table]}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        return spark.table(name)

    def write(self, index: DataFrame, base: dict | None = None, batch_id: str | None = None) -> int:
        """Publish index as the next version; a commit since base is a Conflict.

        Rows that come from a join by the keys with an index of as many buckets are written where they are; others are
        shuffled once, so that each bucket is one file.
        """
        base = base or self.store.manifest()
        name = f"cdclake_{uuid.uuid4().hex}"
        folder = f"{self.store.root}/{self.table}/{name.removeprefix('cdclake_')}"
        index.repartition(self.buckets, *self.keys).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", folder).format("parquet").saveAsTable(name)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema)
        new = base | {"tables": base["tables"] | {self.table: {"": folder}}, "schemas": base["schemas"] | {self.table: schema}, "buckets": base.get("buckets", {}) | {self.table: self._spec()}}
        return self.store.commit({}, batch_id=batch_id, base=new)

    def actions(self, batch: DataFrame, policy: Policy = COMBINED, base: dict | None = None) -> DataFrame:
        """What the winners of a batch do, given the index; see operators.merge.actions."""
        index = self.read(base)
        if index is None:
            index = batch.limit(0).select(*self.keys, "ut", F.lit(True).alias("live"))
        return actions(batch, index, self.keys, policy)

    def merge(self, batch: DataFrame, policy: Policy = COMBINED, batch_id: str | None = None) -> DataFrame:
        """Merge a batch into the index and return what it did, written to the shared folder; a batch that was merged does nothing."""
        spark, base = self.store.spark, self.store.manifest()
        path = new_path(spark, "bucketed-actions")
        done = self.store.has_batch(base, batch_id)
        acted = self.actions(batch.limit(0) if done else batch, policy, base)
        acted.write.parquet(path)
        acted = spark.read.schema(acted.schema).parquet(path)
        if not done:
            index = self.read(base)
            fresh = entries(acted, self.keys)
            self.write(fresh if index is None else after(index, fresh, self.keys, self.buckets), base, batch_id)
        return acted


def entries(acted: DataFrame, keys: list[str]) -> DataFrame:
    """The index entries that a batch's actions leave."""
    applied = acted.where(F.col("action").isin(*APPLIED))
    return applied.groupBy(*keys).agg(F.max("ut").alias("ut"), F.max(F.col("action").isin("insert", "update")).alias("live"))


def after(index: DataFrame, fresh: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The index with fresh entries in place of its own. Both parts lie in the index's buckets, so their union does."""
    fresh = fresh.repartition(buckets, *keys)
    kept = index.join(fresh.select(*keys), keys, "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)

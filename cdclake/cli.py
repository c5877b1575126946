"""Maintenance from the command line: python -m cdclake.cli OPERATION ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cdclake.maintenance import remove_duplicates
from cdclake.operators import ddl, marks
from cdclake.sources import files
from cdclake.sources.store import BUCKET, Store
from cdclake.streaming.merge import rebuild_index


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cdclake")
    ops = p.add_subparsers(dest="operation", required=True)

    def add(name: str, *options: tuple[str, dict]) -> None:
        sub = ops.add_parser(name)
        for flag, how in options:
            sub.add_argument(flag, **how)

    store = [("--store", {"required": True}), ("--by", {"default": "p_y,p_m,p_d"})]
    add("create-tables", ("--catalog", {}), ("--url", {}), ("--query", {}), ("--table", {}), ("--include-digits", {"action": "store_true"}), ("--execute", {"action": "store_true"}))
    add("set-check-time", ("--marks", {"required": True}), ("--out", {"required": True}), ("--db", {"required": True}), ("--table", {"required": True}), ("--partition", {}), ("--time-millis", {"type": int, "required": True}))
    add("rebuild-index", *store, ("--key", {"required": True}), ("--filter", {}))
    add("cat", ("--path", {"required": True}), ("--format", {"default": "parquet"}))
    add("cat-index", ("--store", {"required": True}), ("--key", {"required": True}), ("--ids", {"required": True}))
    add("remove-duplicates", *store, ("--key", {"required": True}), ("--newest", {"required": True}), ("--filter", {}), ("--execute", {"action": "store_true"}))
    add("compact", *store, ("--files", {"type": int, "default": 5}), ("--filter", {}))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    """Run an operation; returns what it made, for callers in Python."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.operation == "create-tables":
        if bool(a.catalog) == bool(a.url and a.query):
            raise SystemExit("create-tables takes --catalog, a table of columns, or --url and --query of a database that has them")
        catalog = spark.read.parquet(a.catalog) if a.catalog else files.source_catalog(spark, a.url, a.query)
        made = ddl.statements(catalog, a.table.split(",") if a.table else None, a.include_digits)
        print(*made.values(), sep=";\n")
        if a.execute:
            ddl.create_tables(spark, made)
        return made
    if a.operation == "set-check-time":
        scopes = [marks.scope(a.db, t, a.partition) for t in a.table.split(",")]
        out = marks.set_check_time(spark, spark.read.parquet(a.marks), scopes, a.time_millis)
        out.write.parquet(a.out)
        return out
    if a.operation == "cat":
        out = files.dump(spark, a.path, a.format)
        out.show(truncate=False)
        return out
    keys = a.key.split(",") if getattr(a, "key", None) else []
    store = Store(spark, a.store, a.by.split(",") if getattr(a, "by", None) else None)
    if a.operation == "cat-index":
        kind = store.read("index").schema[keys[0]].dataType
        ids = spark.createDataFrame([(i,) for i in a.ids.split(",")], "id string").select(F.col("id").cast(kind).alias(keys[0]))
        out = files.index_lookup(ids, store.read("index").drop(BUCKET), keys[0])
        out.show(truncate=False)
        return out
    if a.operation == "compact":
        return store.compact("rows", a.files, a.filter)
    if a.operation == "rebuild-index":
        return rebuild_index(store, keys, predicate=a.filter)
    out = remove_duplicates(store, keys, a.newest, a.filter, a.execute)
    for p in out["partitions"]:
        print(" ".join(f"{k}={v}" for k, v in p.items()))
    print(f"backup: version {out['backup']}; now: version {out['version']}" if a.execute else "nothing was changed: give --execute to remove them")
    return out


if __name__ == "__main__":
    main()

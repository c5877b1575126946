"""Schemas, marks, tasks, settings and the command line."""

from __future__ import annotations

import datetime
import json
import os
import time
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from cdclake.cli import main
from cdclake.config import Settings
from cdclake.maintenance import remove_duplicates
from cdclake.operators import ddl, marks, metrics, tasks
from cdclake.sources import files
from cdclake.sources.store import Store
from cdclake.streaming.ingest import change_batch, ingest, run_until
from cdclake.streaming.merge import merge_batch
from cdclake.streaming.monitor import Counters, serve
from cdclake.streaming.tasks import consume, publish
from tests.conftest import SMALL

CATALOG = [("shop1", "orders", "id", "int(11)"), ("shop1", "orders", "Create_Time", "datetime"), ("shop2", "orders", "id", "int(11)"), ("shop2", "orders", "Create_Time", "datetime"), ("shop1", "plain", "id", "int(11)")]


def test_ddl(spark):
    made = ddl.statements(spark.createDataFrame(CATALOG, "db string, table string, name string, type string"))
    assert list(made) == ["shop.orders"] and "`create_time` timestamp, `id` bigint" in made["shop.orders"]
    bad = spark.createDataFrame([("d", "t", "create_time", "bit(1)")], "db string, table string, name string, type string")
    with pytest.raises(ValueError, match="create_time"):
        ddl.statements(bad)


def test_marks(spark):
    old = spark.createDataFrame([("d.t", 5, None)], marks.MARKS)
    new = marks.advanced(old, spark.createDataFrame([("d.t", 3, None), ("d.u", 4, None)], marks.MARKS))
    assert {r.scope: r.stream_update_time for r in new.collect()} == {"d.t": 5, "d.u": 4}
    checked = {r.scope: r.check_update_time for r in marks.set_check_time(spark, new, ["d.t", "d.x"], 9).collect()}
    assert checked == {"d.t": 9, "d.u": None, "d.x": 9}


def test_ledger(spark):
    files = spark.createDataFrame([("d", "t", "p", "f", "a")] * 3, "db string, table_name string, partition_name string, file_path string, op string")
    ledger = spark.createDataFrame(tasks.new_tasks(files).collect())
    one = ledger.limit(1)
    after = tasks.with_status(ledger, one, tasks.DELAY)
    assert sorted((r.status, r.attempt) for r in after.collect()) == [("DELAY", 1), ("NEW", 0), ("NEW", 0)]
    assert tasks.with_status(ledger, one, tasks.SUCCESS, delete=True).count() == 2
    assert tasks.delayed(after, F.current_timestamp() + F.expr("interval 2 hours")).count() == 3
    bad = spark.createDataFrame([("{not json",), ('{"id": "1"}',)], "message string")
    assert [r.id for r in tasks.decode(bad).collect()] == ["1"]


def test_settings():
    assert Settings.load('{"root": "x", "partition_columns": ["p"]}').partition_columns == ("p",)
    with pytest.raises(ValueError):
        Settings.load('{"rot": 1}')


def test_command_line(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store = Store(spark, root, ["p"])
    rows = spark.createDataFrame([(k, "c", k, k, k % 2) for k in range(6)], "k bigint, op string, ut bigint, seq bigint, p int")
    merge_batch(store, rows, ["k"])
    doubled = store.read("rows").unionByName(store.read("rows").where("k = 2").withColumn("ut", F.lit(0).cast("bigint")))
    store.commit({"rows": doubled}, {"rows": doubled.select("p").distinct()})
    remove = ["remove-duplicates", "--store", root, "--by", "p", "--key", "k", "--newest", "ut"]
    assert [p["surplus"] for p in main(remove, spark)["partitions"]] == [1]
    assert store.read("rows").count() == 7  # a dry run
    done = main([*remove, "--execute"], spark)
    assert sorted((r.k, r.ut) for r in store.read("rows").collect()) == [(k, k) for k in range(6)]
    assert store.read("rows", done["backup"]).count() == 7
    assert {r.k: r.ut for r in store.read("index").collect()} == {k: k for k in range(6)}
    main(["rebuild-index", "--store", root, "--by", "p", "--key", "k"], spark)
    assert sorted(r.k for r in store.read("index").collect()) == list(range(6))
    main(["compact", "--store", root, "--by", "p", "--files", "0"], spark)
    assert store.read("rows").count() == 6
    got = main(["cat-index", "--store", root, "--key", "k", "--ids", "2,77"], spark)
    assert {r.k: r.ut for r in got.collect()} == {2: "2", 77: "EMPTY"}
    assert main(["cat", "--path", f"{root}/rows"], spark).count() >= 6


def test_repair_without_an_index(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", ["p"])
    rows = spark.createDataFrame([(1, 1, 0), (1, 2, 0), (2, 1, 1), (None, 3, 0)], "k bigint, ut bigint, p int")
    store.commit({"rows": rows}, {"rows": rows.select("p")})
    assert not remove_duplicates(store, ["k"], "ut", "p = 1", execute=True)["partitions"]
    remove_duplicates(store, ["k"], "ut", execute=True)
    assert sorted((r.k, r.ut) for r in store.read("rows").collect()) == [(1, 2), (2, 1)]
    assert {r.k: (r.ut, r.p) for r in store.read("index").collect()} == {1: (2, 0), 2: (1, 1)}


def test_create_tables(spark):
    made = {"made_here.orders": "CREATE TABLE IF NOT EXISTS `made_here`.`orders` (`id` bigint) USING parquet PARTITIONED BY (p_y INT, p_m INT, p_d INT)"}
    made["made_here.orders"] = ddl.TEMPLATE.format(db="made_here", table="orders", columns="`id` bigint, p_y INT, p_m INT, p_d INT", format="parquet").replace("(p_y INT, p_m INT, p_d INT)", "(p_y, p_m, p_d)")
    ddl.create_tables(spark, made)
    try:
        assert spark.table("made_here.orders").columns == ["id", "p_y", "p_m", "p_d"]
    finally:
        spark.sql("DROP SCHEMA made_here CASCADE")


def test_files_per_trigger(spark, tmp_path):
    """A batch takes so many files; done files go to the archive."""
    spark.range(40).repartition(4).write.parquet(f"{tmp_path}/in")
    sizes = []
    stream = files.staged_stream(spark, f"file://{tmp_path}/in", spark.range(1).schema, files_per_trigger=2, archive=f"file://{tmp_path}/archive")
    stream.writeStream.foreachBatch(lambda b, n: sizes.append(b.count())).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 2 and sum(sizes) == 40


def test_create_tables_by_jdbc(spark, tmp_path):
    query = "SELECT 'shop1' AS db, 'orders' AS \"TABLE\", 'Create_Time' AS name, 'datetime' AS type FROM SYSIBM.SYSDUMMY1"
    made = main(["create-tables", "--url", f"jdbc:derby:{tmp_path}/source;create=true", "--query", query], spark)
    assert list(made) == ["shop.orders"]
    with pytest.raises(SystemExit):
        main(["create-tables"], spark)


def test_catalog_by_jdbc(spark, tmp_path):
    query = "SELECT 'shop' AS db, t.TABLENAME AS \"TABLE\", c.COLUMNNAME AS name, CAST(c.COLUMNDATATYPE AS VARCHAR(64)) AS type FROM SYS.SYSCOLUMNS c JOIN SYS.SYSTABLES t ON t.TABLEID = c.REFERENCEID"
    found = files.source_catalog(spark, f"jdbc:derby:{tmp_path}/source;create=true", query, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert found.columns == ["db", "table", "name", "type"] and found.where("table = 'SYSTABLES' and name = 'TABLEID'").count() == 1


def test_tasks(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", ["p"])
    rows = spark.createDataFrame([(k, "c", k, k, k % 2) for k in range(6)], "k bigint, op string, ut bigint, seq bigint, p int")
    assert publish(store, rows, f"file://{tmp_path}/staged", "db", "t") == 2
    assert publish(store, rows.where("k = 1"), f"file://{tmp_path}/staged", "db", "t") == 1
    lost = store.read("ledger").where("partition_name = 'p=0'").first().file_path
    store._fs.delete(store._path(lost), False)  # merged by someone else, or lost: done
    assert consume(store, ["k"], backup=f"file://{tmp_path}/done") == {"SUCCESS": 3}
    assert sorted(r.k for r in store.read("rows").collect()) == [1, 3, 5]
    assert len(list((tmp_path / "done").rglob("*.processed"))) == 2
    assert consume(store, ["k"]) == {}
    publish(store, rows.withColumn("op", F.lit("?")), f"file://{tmp_path}/staged", "db", "t")
    assert consume(store, ["k"]) == {"FAIL": 2}
    assert len(list((tmp_path / "staged").rglob("*.error"))) == 2


def test_ingest_of_two_databases(spark, tmp_path):
    settings = Settings.load(json.dumps({"root": f"file://{tmp_path}", "databases": {"shop1": "shop", "pay2": "pay"}, "partition_columns": ["p_y", "p_m", "p_d"]}))
    kind = "before struct<id: bigint, create_time: timestamp, update_time: timestamp>, after struct<id: bigint, create_time: timestamp, update_time: timestamp>, op string, key struct<id: bigint>, seq bigint"
    at = datetime.datetime(2018, 7, 11)
    for db, n in (("shop1", 3), ("pay2", 2)):
        spark.createDataFrame([(None, (k, at, at), "c", (k,), k) for k in range(n)], kind).write.parquet(f"{tmp_path}/in/{db}")
    schema = spark.read.parquet(f"{tmp_path}/in/pay2").schema
    queries = ingest(spark, settings, lambda db: files.staged_stream(spark, f"file://{tmp_path}/in/{db}", schema), lambda e: change_batch(e, "update_time", "seq"), ["id"], once=True)
    run_until(spark, queries, f"file://{tmp_path}/stop", 0.2)
    assert {t: Store(spark, f"file://{tmp_path}/{t}", ["p_y", "p_m", "p_d"]).read("rows").where("p_d = 11").count() for t in queries} == {"shop": 3, "pay": 2}
    (tmp_path / "stop").touch()
    running = ingest(spark, settings, lambda db: files.staged_stream(spark, f"file://{tmp_path}/in/{db}", schema), lambda e: change_batch(e, "update_time", "seq"), ["id"])
    run_until(spark, running, f"file://{tmp_path}/stop", 0.2)
    assert not any(q.isActive for q in running.values())


def test_counters_over_http(spark, tmp_path):
    counters = Counters()
    spark.streams.addListener(counters)
    server = serve(counters)
    try:
        spark.range(7).write.parquet(f"{tmp_path}/in")
        stream = files.staged_stream(spark, f"file://{tmp_path}/in", spark.range(1).schema)
        stream.writeStream.queryName("seven").foreachBatch(lambda b, n: b.count()).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        deadline = time.time() + 30
        while ("seven", "ends") not in counters.found and time.time() < deadline:
            time.sleep(0.1)
        shown = urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics").read().decode()
        assert 'cdclake_rows{query="seven"} 7\n' in shown and 'cdclake_batches{query="seven"} 1\n' in shown
        with pytest.raises(urllib.error.HTTPError):
            urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/")
    finally:
        spark.streams.removeListener(counters)
        server.shutdown()


def test_files_are_sorted_by_key(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", ["p"], index_buckets=2)
    merge_batch(store, spark.createDataFrame([(k * 7919 % 1000, "c", 1, k, k % 2) for k in range(500)], "k bigint, op string, ut bigint, seq bigint, p int"), ["k"])
    for file in [*store.read("index").inputFiles(), *store.read("rows").inputFiles()]:
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys) and keys


def test_table_size(spark):
    table = spark.read.parquet(f"{SMALL}/nation.parquet")
    assert metrics.table_megabytes(table) == pytest.approx(os.path.getsize(f"{SMALL}/nation.parquet") / 1024**2)

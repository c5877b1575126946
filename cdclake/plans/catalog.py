"""The queries over the test tables, each beside its SQL.

The CDC view of `events`: key user_id; op c for signup, d for error, else u; ut the day in ms, so that ties occur;
seq event_id. Batch 1 is what has an even id and a user not divisible by 3, batch 2 the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake import functions as fn
from cdclake.operators import merge as m
from cdclake.operators import ddl, marks, metrics, repair, tasks
from cdclake.operators.envelope import flatten, operation, partitioned, source_database
from cdclake.operators.flush import flushed_batch
from cdclake.sources import files
from cdclake.sources.bucketed import BucketedIndex
from cdclake.sources.shared import new_path
from cdclake.sources.store import Store
from cdclake.streaming.marks import marks_stream
from cdclake.streaming.merge import merge_batch, merge_stream
from cdclake.streaming.state import flushed, live_rows, run_available, versioned
from cdclake.streaming.tasks import consume, publish

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["user_id"]
_found: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _found[f.__name__] = (f, sql)
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_rows(events: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events.select("user_id", op.alias("op"), fn.update_ms(F.date_trunc("day", "ts")).alias("ut"), F.col("event_id").alias("seq"), "value")


def first_batch() -> F.Column:
    return (F.col("seq") % 2 == 0) & (F.col("user_id") % 3 != 0)


def batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = change_rows(table(spark, sf_dir, "events"))
    return rows.where(first_batch()), rows.where(~first_batch())


VIEW = """
WITH ch AS (SELECT user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  epoch_ms(date_trunc('day', ts)::TIMESTAMP) AS ut, event_id AS seq, value FROM events),
b1 AS (SELECT * FROM ch WHERE seq % 2 = 0 AND user_id % 3 <> 0),
b2 AS (SELECT * FROM ch WHERE NOT (seq % 2 = 0 AND user_id % 3 <> 0)),
w1 AS (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ut DESC, seq DESC) = 1),
w2 AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ut DESC, seq DESC) = 1),
f2 AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ut DESC, seq) = 1),
a AS (SELECT w2.*, w1.ut AS x_ut, CASE WHEN w1.user_id IS NULL AND w2.op = 'd' THEN 'tombstone'
  WHEN w1.user_id IS NULL THEN 'insert' WHEN w2.op = 'c' THEN 'skip_create' WHEN w2.ut < w1.ut THEN 'skip_late'
  WHEN w2.op = 'd' THEN 'delete' ELSE 'update' END AS action FROM w2 LEFT JOIN w1 USING (user_id))
"""


@query("SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max_by(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts").cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "events").select("user_id", F.lit("u").alias("op"), micros.alias("ut"), F.col("event_id").alias("seq"), "value")
    return m.winners(rows, KEYS).select("user_id", F.col("seq").alias("event_id"), "value")


@query(VIEW + "SELECT user_id, op, ut, seq, value FROM ch QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ut DESC, seq) = 1")
def first_wins_tie_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.winners(change_rows(table(spark, sf_dir, "events")), KEYS, last_wins=False).select("user_id", "op", "ut", "seq", "value")


def merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows and index after both batches, and the actions of each."""
    one, two = batches(spark, sf_dir)
    rows = one.limit(0).select("user_id", "ut", "value")
    index = rows.select("user_id", "ut", F.lit(True).alias("live"))
    first = m.actions(one, index, KEYS)
    rows, index = m.apply(rows, index, first, KEYS)
    second = m.actions(two, index, KEYS)
    return *m.apply(rows, index, second, KEYS), first, second


STATE_SQL = VIEW + """
SELECT user_id, ut, value FROM w1 WHERE op <> 'd' AND user_id NOT IN (SELECT user_id FROM a WHERE action IN ('update', 'delete'))
UNION ALL SELECT user_id, ut, value FROM a WHERE action IN ('insert', 'update')
"""


@query(STATE_SQL)
def cdc_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)[0]


@query(VIEW + "SELECT CASE WHEN action = 'tombstone' THEN 'delete' WHEN action = 'insert' AND op = 'u' THEN 'update' ELSE action END AS action, count(*) AS n FROM a GROUP BY 1")
def cdc_merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.counters(merged(spark, sf_dir)[3])


def _index(one: DataFrame) -> DataFrame:
    return m.winners(one, KEYS).select("user_id", "ut", (F.col("op") != "d").alias("live"))


@query(VIEW + "SELECT f2.user_id, f2.op, f2.ut, CASE WHEN w1.user_id IS NULL THEN CASE f2.op WHEN 'd' THEN 'skip_missing' ELSE 'insert' END WHEN f2.ut <= w1.ut THEN 'skip_late' WHEN f2.op = 'd' THEN 'delete' ELSE 'update' END AS action FROM f2 LEFT JOIN w1 USING (user_id)")
def cdc_update_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = batches(spark, sf_dir)
    return m.actions(two, _index(one), KEYS, m.UPDATE_INSERT_MISSING).select("user_id", "op", "ut", "action")


@query(VIEW + "SELECT f2.user_id, f2.op, f2.ut, CASE WHEN f2.ut <= w1.ut THEN 'skip_late' WHEN f2.op = 'd' THEN 'delete' ELSE 'update' END AS action FROM f2 JOIN w1 USING (user_id)")
def cdc_update_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict policy over the keys that are there: with others in the batch it applies nothing."""
    one, two = batches(spark, sf_dir)
    index = _index(one)
    there = two.join(index.select("user_id"), "user_id", "left_semi")
    return m.actions(there, index, KEYS, m.UPDATE_STRICT).select("user_id", "op", "ut", "action")


@query(VIEW + "SELECT user_id, op FROM f2 WHERE user_id NOT IN (SELECT user_id FROM w1)")
def cdc_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = batches(spark, sf_dir)
    return m.missing_keys(two, _index(one), KEYS).select("user_id", "op")


@query(VIEW + "SELECT seq, user_id, CASE WHEN user_id IN (SELECT user_id FROM w1) THEN 'skip_create' ELSE 'insert' END AS action FROM b2")
def cdc_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = batches(spark, sf_dir)
    return m.actions(two, _index(one), KEYS, m.INSERT_ONLY).select("seq", "user_id", "action")


@query(VIEW + "SELECT user_id, ut FROM a WHERE action IN ('tombstone', 'delete') UNION ALL SELECT user_id, ut FROM w1 WHERE op = 'd' AND user_id NOT IN (SELECT user_id FROM a WHERE action IN ('update', 'delete'))")
def tombstoned_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)[1].where("not live").select("user_id", "ut")


@query(VIEW + "SELECT user_id, ut, x_ut FROM a WHERE action = 'skip_late'")
def late_events_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)[3].where("action = 'skip_late'").select("user_id", "ut", "x_ut")


APPLIED = "action IN ('insert', 'update', 'delete', 'tombstone')"


@query(VIEW + f"SELECT year(make_timestamp(ut * 1000))::INT AS p_y, month(make_timestamp(ut * 1000))::INT AS p_m, max(ut) AS mark FROM a WHERE {APPLIED} GROUP BY 1, 2")
def partition_high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    acted = merged(spark, sf_dir)[3]
    at = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("ut") / 1000)
    return m.high_water_marks(acted.withColumns({"p_y": F.year(at), "p_m": F.month(at)}), ["p_y", "p_m"])


@query(VIEW + f"SELECT greatest((SELECT max(ut) FROM a WHERE {APPLIED}), (SELECT max(ut) FROM w1)) AS mark")
def table_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    *_, first, second = merged(spark, sf_dir)
    return m.high_water_marks(second, [], m.high_water_marks(first, []))


@query("SELECT o_orderkey, year(o_orderdate)::INT AS p_y, month(o_orderdate)::INT AS p_m, day(o_orderdate)::INT AS p_d FROM orders")
def partition_ymd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", *fn.partition_values(F.col("o_orderdate")))


@query("SELECT event_id, 'p_y=' || year(ts) || '/p_m=' || month(ts) || '/p_d=' || day(ts) AS name, year(ts)::VARCHAR AS y FROM events")
def partition_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fn.partition_name(*fn.partition_values(F.col("ts")))
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"), fn.parse_partition_name(name)["p_y"].alias("y"))


def by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, mth, _ = fn.partition_values(F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").withColumns({"p_y": y, "p_m": mth})


LINE_KEYS = ["l_orderkey", "l_linenumber"]
NEWEST_SQL = "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
PARTS_SQL = """WITH l AS (SELECT *, year(l_shipdate)::INT AS p_y, month(l_shipdate)::INT AS p_m FROM lineitem),
d AS (SELECT p_y, p_m, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_ids, count(*) AS ids FROM l GROUP BY 1, 2 HAVING distinct_ids <> ids)
"""


def newest() -> list:
    names = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return [F.col("l_shipdate").desc(), *[F.col(n) for n in names]]


@query(PARTS_SQL + "SELECT *, ids - distinct_ids AS surplus FROM d ORDER BY p_y, p_m")
def duplicate_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.duplicate_partitions(by_month(spark, sf_dir), F.struct(*LINE_KEYS), ["p_y", "p_m"]).orderBy("p_y", "p_m")


@query(f"SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST_SQL}) = 1")
def unique_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = repair.ranked(table(spark, sf_dir, "lineitem"), LINE_KEYS, newest()).where("rowno = 1")
    return first.select(*LINE_KEYS, "l_shipdate", "l_partkey", "l_extendedprice")


@query(PARTS_SQL + f""", r AS (SELECT l.* FROM l SEMI JOIN d USING (p_y, p_m)),
u AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST_SQL}) = 1),
v AS (SELECT 'raw' AS state, l_orderkey, l_linenumber FROM r UNION ALL SELECT 'repaired', l_orderkey, l_linenumber FROM u)
SELECT state, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_ids, count(*) AS ids, count(DISTINCT (l_orderkey, l_linenumber)) = count(*) AS valid FROM v GROUP BY state""")
def repair_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions that hold keys twice, as they are and repaired: the first fails the validation."""
    rows = by_month(spark, sf_dir)
    flagged = repair.duplicate_partitions(rows, F.struct(*LINE_KEYS), ["p_y", "p_m"])
    states = {"raw": repair.in_partitions(rows, flagged, ["p_y", "p_m"]), "repaired": repair.in_partitions(repair.repaired(rows, LINE_KEYS, newest(), ["p_y", "p_m"]), flagged, ["p_y", "p_m"])}
    out = [repair.validation(r, F.struct(*LINE_KEYS)).select(F.lit(k).alias("state"), "distinct_ids", "ids", "valid") for k, r in states.items()]
    return out[0].unionByName(out[1])


@query("SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_ids, count(DISTINCT (l_orderkey, l_linenumber)) AS first_rows FROM lineitem")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of rank 1, which are as many as keys."""
    rows = repair.ranked(table(spark, sf_dir, "lineitem"), LINE_KEYS, newest())
    return repair.validation(rows, F.struct(*LINE_KEYS), F.col("rowno")).select("distinct_ids", "first_rows")


@query(PARTS_SQL + f""", r AS (SELECT l.* FROM l SEMI JOIN d USING (p_y, p_m)),
u AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST_SQL}) = 1),
t AS (SELECT * FROM u UNION ALL SELECT l.* FROM l ANTI JOIN d USING (p_y, p_m))
SELECT p_y, p_m, count(*) AS rows, round(sum(l_quantity), 2) AS quantity FROM t GROUP BY 1, 2""")
def repaired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.repaired(by_month(spark, sf_dir), LINE_KEYS, newest(), ["p_y", "p_m"])
    return rows.groupBy("p_y", "p_m").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT o_orderkey, o_orderkey || '_' || o_custkey AS key FROM orders")
def business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.business_key("o_orderkey", "o_custkey").alias("key"))


@query(
    """WITH k AS (SELECT o_orderkey, o_orderkey::VARCHAR AS s FROM orders),
h AS (SELECT o_orderkey, s, list_reduce(list_prepend(0::HUGEINT, list_transform(string_split(s, ''), lambda c: ord(c)::HUGEINT)), lambda a, b: (a * 31 + b) % 4294967296) AS u FROM k),
i AS (SELECT o_orderkey, s, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS n FROM h)
SELECT o_orderkey, (n % 10)::VARCHAR || '_' || s AS key FROM i"""
)
def business_key_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.business_key_salted("o_orderkey").alias("key"))


@query("SELECT l_orderkey || '_0_' || l_partkey AS record_id, l_orderkey AS txn, 0 AS bucket, l_partkey AS row_id FROM lineitem")
def record_id_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("_", "l_orderkey", F.lit("0"), "l_partkey").alias("record_id"))
    return rows.withColumn("r", fn.split_record_id(F.col("record_id"))).select("record_id", "r.*")


@query("SELECT o_orderkey, date_trunc('second', o_orderdate)::TIMESTAMP AS at FROM orders")
def zoned_wallclock(spark: SparkSession, sf_dir: str) -> DataFrame:
    zoned = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.element_at(F.array(F.lit("+08:00"), F.lit("Z"), F.lit("-05:00")), (F.col("o_orderkey") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.wall_clock(zoned).alias("at"))


@query("SELECT p_brand, p_name, p_partkey::BIGINT AS p_partkey, p_retailprice::DOUBLE AS p_retailprice, p_size::BIGINT AS p_size, p_type FROM part")
def widened_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.widen(table(spark, sf_dir, "part"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS ut FROM events")
def update_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", fn.update_ms(F.when(F.col("event_id") % 7 != 0, F.col("ts"))).alias("ut"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def op_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.operation_metrics(table(spark, sf_dir, "events"), ["event_type"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def insert_if_absent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return m.insert_if_absent(table(spark, sf_dir, "orders"), index, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(VIEW + "SELECT i.user_id, coalesce(w1.ut::VARCHAR, 'EMPTY') AS ut FROM (SELECT DISTINCT user_id FROM ch) i LEFT JOIN w1 USING (user_id)")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's entry in the index of batch 1, which lacks some."""
    index = _index(batches(spark, sf_dir)[0]).select("user_id", "ut")
    return files.index_lookup(table(spark, sf_dir, "events").select("user_id").distinct(), index, "user_id")


@query(VIEW + "SELECT user_id, max(ut) AS ut, true AS live FROM ch GROUP BY 1")
def index_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.index_of(change_rows(table(spark, sf_dir, "events")), KEYS)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger out of events: a task for each, of the user's partition."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 5 == 0, "SUCCESS").when(F.col("event_id") % 5 == 1, "DELAY").otherwise("NEW")
    return e.select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), F.lit("db").alias("db"), "event_type", F.col("event_type").alias("table_name"), F.concat(F.lit("u="), F.col("user_id") % 10).alias("partition_name"), status.alias("status"), (F.col("event_id") % 6).cast("int").alias("attempt"), F.col("ts").alias("create_time"))


LEDGER_SQL = """WITH t AS (SELECT lpad(event_id::VARCHAR, 12, '0') AS id, event_type AS table_name, 'u=' || (user_id % 10) AS partition_name,
CASE event_id % 5 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'DELAY' ELSE 'NEW' END AS status, (event_id % 6)::INT AS attempt, ts AS create_time FROM events)
"""


@query(LEDGER_SQL + "SELECT id, table_name, partition_name FROM t WHERE status = 'NEW' QUALIFY row_number() OVER (PARTITION BY table_name, partition_name ORDER BY id) <= 6")
def greedy_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.greedy(ledger(spark, sf_dir)).select("id", "table_name", "partition_name")


@query(LEDGER_SQL + "SELECT id, attempt FROM t WHERE status IN ('NEW', 'DELAY') AND attempt <= 3 AND create_time <= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 1 HOUR")
def delayed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.to_timestamp_ntz(F.lit("2024-01-10 00:00:00"))
    return tasks.delayed(ledger(spark, sf_dir), now).select("id", "attempt")


@query("SELECT event_id::VARCHAR AS id, event_type AS tbl, (event_id % 4)::INT AS attempt, 3 AS depth FROM events")
def task_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, mth, d = (c.cast("string") for c in fn.partition_values(F.col("ts")))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.lit("db").alias("db"), F.col("event_type").alias("tbl"), F.array(y, mth, d).alias("partitions"), (F.col("event_id") % 4).cast("int").alias("attempt"))
    return tasks.decode(tasks.encode(rows)).select("id", "tbl", "attempt", F.size("partitions").alias("depth"))


TYPES = ["int(11)", "int(11) unsigned", "INT UNSIGNED", "decimal(10,2) unsigned", "double(2,3)", "tinyint(1)", "varchar(32)", "DECIMAL(10,2)", "datetime", "bigint(20)", "date", "enum('a','b')", "longtext", "bit(1)", "double"]


@query(
    "SELECT s AS source, t AS target FROM (VALUES ('int(11)','bigint'),('int(11) unsigned','bigint'),('INT UNSIGNED','bigint'),('decimal(10,2) unsigned','double'),('double(2,3)','double'),('tinyint(1)','bigint'),('varchar(32)','string'),('DECIMAL(10,2)','double'),('datetime','timestamp'),('bigint(20)','bigint'),('date','date'),('enum(''a'',''b'')','string'),('longtext','string'),('bit(1)',NULL),('double','double')) v(s, t)"
)
def ddl_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(t,) for t in TYPES], "source string")
    return rows.withColumn("target", fn.sql_type(F.col("source")))


@query("SELECT event_id, regexp_extract(d, '([a-zA-Z\\-_]+)([0-9]+)', 1) AS db FROM (SELECT event_id, event_type || '_' || (event_id % 32) AS d FROM events)")
def shard_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.concat_ws("_", "event_type", (F.col("event_id") % 32).cast("string")).alias("d"))
    return rows.select("event_id", source_database(F.col("d")).alias("db"))


@query(
    "SELECT event_id, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, CASE WHEN event_type = 'error' THEN -value ELSE value END AS value, year(ts)::INT AS p_y, month(ts)::INT AS p_m, day(ts)::INT AS p_d FROM events"
)
def envelope_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    after = F.struct(F.col("value").alias("Value"), F.col("ts").alias("createdAt"))
    before = F.struct((-F.col("value")).alias("Value"), F.col("ts").alias("createdAt"))
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "C").otherwise("u")
    key = F.struct(F.col("event_id").alias("Id"), F.lit("t").alias("__dbz__physicalTableIdentifier"))
    rows = partitioned(flatten(e.select(before.alias("before"), F.when(F.col("event_type") != "error", after).alias("after"), op.alias("op"), key.alias("key"))))
    return rows.select(F.col("key.id").alias("event_id"), "op", "after.value", "p_y", "p_m", "p_d")


def _partitioned(batch: DataFrame) -> DataFrame:
    """A batch with the month of its update time as partition, so that rows move when they are updated."""
    return batch.withColumn("p_m", F.month(F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("ut") / 1000)))


@query(STATE_SQL)
def store_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches through snapshot commits; the second one twice, which changes nothing."""
    store = Store(spark, new_path(spark, "store"), ["p_m"], index_buckets=4)
    for k, batch in (("1", 0), ("2", 1), ("2", 1)):
        merge_batch(store, _partitioned(batches(spark, sf_dir)[batch]), KEYS, batch_id=k)
    return store.read("rows").select("user_id", "ut", "value")


@query(STATE_SQL)
def unpartitioned_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, new_path(spark, "store"), index_buckets=2)
    for batch in batches(spark, sf_dir):
        merge_batch(store, batch, KEYS)
    return store.read("rows").select("user_id", "ut", "value")


@query(VIEW + "SELECT user_id, ut, op <> 'd' AS live FROM w1 WHERE user_id NOT IN (SELECT user_id FROM a WHERE action NOT LIKE 'skip%') UNION ALL SELECT user_id, ut, action IN ('insert', 'update') FROM a WHERE action NOT LIKE 'skip%'")
def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index that two merges leave, put together from the parts that they rewrote."""
    store = Store(spark, new_path(spark, "store"), ["p_m"], index_buckets=4)
    for batch in batches(spark, sf_dir):
        merge_batch(store, _partitioned(batch), KEYS)
    return store.read("index").select("user_id", "ut", "live")


@query(VIEW + f""", p AS (SELECT month(make_timestamp(ut * 1000))::INT AS p_m, ut FROM a WHERE {APPLIED} UNION ALL SELECT month(make_timestamp(ut * 1000))::INT, ut FROM w1)
SELECT p_m, max(ut) AS mark FROM p GROUP BY 1""")
def stored_partition_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, new_path(spark, "store"), ["p_m"], index_buckets=4)
    for batch in batches(spark, sf_dir):
        merge_batch(store, _partitioned(batch), KEYS)
    return store.read("partition_marks").select("p_m", "mark")


@query(STATE_SQL)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches as files of a stream, all files of a batch in one micro-batch."""
    folder = new_path(spark, "stream")
    store = Store(spark, f"{folder}/store", ["p_m"], index_buckets=4)
    for batch in batches(spark, sf_dir):
        _partitioned(batch).write.mode("append").parquet(f"{folder}/staged")
        stream = files.staged_stream(spark, f"{folder}/staged", _partitioned(batch).schema)
        merge_stream(stream, store, KEYS, f"{folder}/checkpoint").awaitTermination()
    return store.read("rows").select("user_id", "ut", "value")


@query(VIEW + """, b AS (SELECT CASE op WHEN 'c' THEN 'insert' WHEN 'd' THEN 'delete' ELSE 'update' END AS action FROM w1
UNION ALL SELECT CASE WHEN action = 'tombstone' THEN 'delete' WHEN action = 'insert' AND op = 'u' THEN 'update' ELSE action END FROM a)
SELECT 'shop' AS db, 'rows' AS "table", action, count(*) AS n FROM b GROUP BY action""")
def observed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two merges did, counted as their rows went by and kept with the snapshot."""
    store = Store(spark, new_path(spark, "store"), ["p_m"], index_buckets=4)
    for batch in batches(spark, sf_dir):
        merge_batch(store, _partitioned(batch), KEYS)
    return metrics.merge_counters(spark, store.manifest(), "shop")


@query(VIEW + """
SELECT user_id, ut, value, NULL::DOUBLE AS twice FROM w1 WHERE op <> 'd' AND user_id NOT IN (SELECT user_id FROM a WHERE action IN ('update', 'delete'))
UNION ALL SELECT user_id, ut, value, value * 2 FROM a WHERE action IN ('insert', 'update')""")
def merged_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a column that the table lacks, and ids of a narrower type than the table's."""
    store = Store(spark, new_path(spark, "columns"), ["p_m"], index_buckets=4)
    one, two = batches(spark, sf_dir)
    merge_batch(store, _partitioned(one.withColumn("seq", F.col("seq").cast("long"))), KEYS)
    merge_batch(store, _partitioned(two.withColumn("twice", F.col("value") * 2)), KEYS)
    return store.read("rows").select("user_id", "ut", "value", "twice")


@query(
    "SELECT coalesce(text, 'none') AS text, half, moment::VARCHAR AS moment, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE event_type || '/=%' END AS text, (event_id % 3) / 2 AS half, TIMESTAMP '2024-01-01 00:00:00.25' + INTERVAL 1 DAY * (event_id % 2) AS moment FROM events) GROUP BY ALL"
)
def partitions_of_any_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions by a text (empty, null and with odd characters), a fraction and an instant; one of them written again."""
    text = F.when(F.col("event_id") % 4 == 0, "").when(F.col("event_id") % 4 == 1, F.lit(None)).otherwise(F.concat("event_type", F.lit("/=%")))
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00.25")) + F.make_dt_interval(days=(F.col("event_id") % 2).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"), ((F.col("event_id") % 3) / 2).alias("half"), at.alias("moment"))
    store, by = Store(spark, new_path(spark, "parts"), ["text", "half", "moment"]), ["text", "half", "moment"]
    store.commit({"rows": rows}, {"rows": rows})
    empty = store.read("rows", predicate="text = ''")
    store.commit({"rows": empty}, {"rows": empty.select(*by)})
    return store.read("rows").groupBy(F.coalesce("text", F.lit("none")).alias("text"), "half", F.col("moment").cast("string").alias("moment")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both batches change, each in two micro-batches (users of even and odd id), every one after a restart."""
    folder = new_path(spark, "versions")
    for batch in batches(spark, sf_dir):
        for odd in (0, 1):
            batch.where(F.col("user_id") % 2 == odd).write.mode("append").parquet(f"{folder}/staged")
            stream = files.staged_stream(spark, f"{folder}/staged", batch.schema)
            run_available(versioned(stream, KEYS), f"{folder}/changes", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/changes")


@query(STATE_SQL)
def streaming_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that a stream keeps for each key, through restarts."""
    return live_rows(_changes(spark, sf_dir), KEYS).select("user_id", "ut", "value")


@query(VIEW + "SELECT user_id, 1 AS batch, CASE op WHEN 'd' THEN 'tombstone' ELSE 'insert' END AS action, ut FROM w1 UNION ALL SELECT user_id, 2, action, ut FROM a")
def streaming_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each key's winners did, late ones and deletes of unknown keys too."""
    in_first = (F.col("seq") % 2 == 0) & (F.col("user_id") % 3 != 0)
    return _changes(spark, sf_dir).select("user_id", F.when(in_first, 1).otherwise(2).alias("batch"), "action", "ut")


@query(VIEW + f""", p AS (SELECT month(make_timestamp(ut * 1000))::INT AS p_m, day(make_timestamp(ut * 1000))::INT AS p_d, ut FROM a WHERE {APPLIED} UNION ALL SELECT month(make_timestamp(ut * 1000))::INT, day(make_timestamp(ut * 1000))::INT, ut FROM w1)
SELECT p_m, p_d, max(ut) AS mark FROM p GROUP BY ALL""")
def streaming_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks by day of the changes that a stream makes, in four starts of it; the changes of the first come once more, late."""
    folder, store = new_path(spark, "marks"), Store(spark, new_path(spark, "marks-store"))
    changes = _changes(spark, sf_dir)
    at = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("ut") / 1000)
    dated = changes.withColumns({"p_m": F.month(at), "p_d": F.dayofmonth(at)})
    for part in (0, 1, 2, 0):
        dated.where(F.pmod("seq", F.lit(3)) == part).write.mode("append").parquet(f"{folder}/staged")
        stream = files.staged_stream(spark, f"{folder}/staged", dated.schema)
        marks_stream(stream, store, ["p_m", "p_d"], f"{folder}/checkpoint", late="60 days").awaitTermination()
    return store.read("stream_marks").select("p_m", "p_d", "mark")


FILES_SQL = """WITH RECURSIVE e AS (SELECT event_id, event_type, epoch_ms(ts) AS at, row_number() OVER (PARTITION BY event_type ORDER BY epoch_ms(ts), event_id) AS i FROM events),
n AS (SELECT a.event_type, a.i, least(a.i + 50, (SELECT count(*) + 1 FROM e b WHERE b.event_type = a.event_type AND b.at < a.at + 86400000)) AS next FROM e a),
f AS (SELECT event_type, 1::BIGINT AS i, 0::BIGINT AS file FROM e GROUP BY 1 UNION ALL SELECT event_type, n.next, file + 1 FROM f JOIN n USING (event_type, i) WHERE n.next <= (SELECT count(*) FROM e x WHERE x.event_type = f.event_type))
SELECT e.event_id, e.event_type, f.file FROM e ASOF JOIN f ON e.event_type = f.event_type AND e.i >= f.i"""


@query(FILES_SQL)
def flushed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's file, of one writer for each type: 50 rows or a day at most. Days come in three starts of the stream."""
    folder, e = new_path(spark, "flushes"), table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    third = F.least(F.floor(F.dayofyear("ts") / 11), F.lit(2))
    for part in range(3):
        e.where(third == part).write.mode("append").parquet(f"{folder}/staged")
        stream = files.staged_stream(spark, f"{folder}/staged", e.schema)
        run_available(flushed(stream, ["event_type"], "ts", "event_id", most_rows=50, minutes=24 * 60), f"{folder}/files", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/files").select("event_id", "event_type", "file")


@query(FILES_SQL)
def flushed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, of the whole table at once."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return flushed_batch(e, ["event_type"], "ts", "event_id", most_rows=50, minutes=24 * 60).select("event_id", "event_type", "file")


@query(STATE_SQL)
def tasks_equal_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch published as staged files with tasks, which are then worked through; users are partitions of their own."""
    folder = new_path(spark, "tasks")
    store = Store(spark, f"{folder}/store", ["p"], index_buckets=2)
    for batch in batches(spark, sf_dir):
        publish(store, batch.withColumn("p", (F.col("user_id") % 2).cast("int")), f"{folder}/staged", "db", "events")
        consume(store, KEYS)
    return store.read("rows").select("user_id", "ut", "value")


@query(VIEW + "SELECT user_id, ut, value FROM ch QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ut DESC, seq DESC) = 1")
def delayed_batch_goes_in_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict batch waits for its keys, an insert-only one brings them, then the first goes in."""
    folder = new_path(spark, "delayed")
    store = Store(spark, f"{folder}/store", ["p"], index_buckets=2)
    rows = change_rows(table(spark, sf_dir, "events")).withColumn("p", F.lit(1))
    newest = m.winners(rows, KEYS)
    publish(store, newest.withColumn("op", F.lit("u")).withColumn("ut", F.col("ut") + 1), f"{folder}/staged", "db", "events")
    ended = [consume(store, KEYS, m.UPDATE_STRICT)]
    publish(store, newest.withColumn("value", F.lit(0.0)), f"{folder}/staged", "db", "events")
    ended += [consume(store, KEYS, m.INSERT_ONLY), consume(store, KEYS, m.UPDATE_STRICT, delayed_hours=0)]
    if [list(e) for e in ended] != [[tasks.DELAY], [tasks.SUCCESS], [tasks.SUCCESS]]:
        raise RuntimeError(f"tasks ended as {ended}")
    return store.read("rows").select("user_id", (F.col("ut") - 1).alias("ut"), "value")


ORDERS_SQL = "WITH o AS (SELECT year(o_orderdate)::INT AS y, o_orderkey, o_totalprice FROM orders) "


def _orders(spark: SparkSession, sf_dir: str) -> Store:
    """A store of orders by year, each year in two commits."""
    store = Store(spark, new_path(spark, "orders"), ["y"])
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), "o_orderkey", "o_totalprice")
    store.commit({"rows": rows}, {"rows": rows.select("y")})
    return store


@query(ORDERS_SQL + "SELECT y, count(*) AS n FROM o WHERE y <> (SELECT min(y) FROM o) GROUP BY y")
def dropped_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _orders(spark, sf_dir)
    store.drop_partitions("rows", [(store.read("rows").agg(F.min("y")).first()[0],)])
    return store.read("rows").groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query(ORDERS_SQL + "SELECT y, count(*) AS n, max(o_totalprice) AS most FROM o WHERE y >= 1995 GROUP BY y")
def renamed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a query, renamed, its source dropped."""
    store = _orders(spark, sf_dir)
    store.commit({"late": store.read("rows", predicate="y >= 1995")})
    store.rename("late", "late_orders")
    store.drop("rows")
    if store.read("rows") is not None or store.read("late") is not None:
        raise RuntimeError("a dropped or renamed table is still there")
    return store.read("late_orders").groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most"))


@query(ORDERS_SQL + "SELECT y, 1::BIGINT AS files, count(*) AS rows FROM o GROUP BY y")
def compacted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of some files each, after compaction and vacuum."""
    store = _orders(spark, sf_dir)
    base = store.manifest()
    small = store.read("rows", base=base).repartition(3, "o_orderkey")  # three files for each year
    folder = new_path(spark, "small")
    small.withColumn("_part_y", F.col("y")).write.partitionBy("_part_y").parquet(folder)
    base["tables"]["rows"] = {key: f"{folder}/{path.rsplit('/', 1)[1]}" for key, path in base["tables"]["rows"].items()}
    store.commit({}, base=base)
    if metrics.file_stats(store.read("rows").select("*", "_metadata"), ["y"], least=1).isEmpty():
        raise RuntimeError("nothing to compact")
    store.compact("rows", more_than=1)
    store.vacuum(grace_seconds=0)
    return metrics.file_stats(store.read("rows").select("*", "_metadata"), ["y"])


@query("SELECT year(o_orderdate)::INT AS p_y, 1::BIGINT AS files, count(*) AS rows FROM orders GROUP BY 1")
def table_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test table is one file."""
    y = F.year("o_orderdate").alias("p_y")
    return metrics.file_stats(table(spark, sf_dir, "orders").select("*", "_metadata", y), ["p_y"])


@query("SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN value END, -1) AS value FROM events")
def envelope_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.struct(F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("Value"))
    e = table(spark, sf_dir, "events").select(after.alias("after"), F.lit("u").alias("op"), F.struct("event_id").alias("key"))
    return flatten(e, {"value": -1.0}).select("key.event_id", "after.value")


@query("SELECT event_id FROM events WHERE event_id % 4 <> 0")
def null_records_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.when(F.col("event_id") % 4 != 0, F.struct("value"))
    e = table(spark, sf_dir, "events").select(F.when(F.lit(False), F.struct("value")).alias("before"), after.alias("after"), F.lit("u").alias("op"), F.struct("event_id").alias("key"))
    return flatten(e).select("key.event_id")


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN year(current_date) ELSE year(ts) END::INT AS p_y FROM events WHERE event_id % 5 <> 0 OR event_type = 'signup'")
def creates_without_time_go_to_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a create time: creates go to today's partition, others drop out."""
    op = F.when(F.col("event_type") == "signup", "c").otherwise("u")
    after = F.struct(F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("create_time"))
    e = table(spark, sf_dir, "events").select(after.alias("after"), op.alias("op"), F.struct("event_id").alias("key"))
    return partitioned(flatten(e)).select("key.event_id", "p_y")


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'failures' WHEN 'signup' THEN 'accounts' ELSE event_type END AS db FROM events")
def renamed_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.concat("event_type", F.lit("12")).alias("d"))
    return e.select("event_id", source_database(F.col("d"), {"error": "failures", "signup": "accounts"}).alias("db"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'd' WHEN 1 THEN 'u' END AS op FROM events")
def operation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(F.lit("D"), F.lit("u"), F.lit("x")), (F.col("event_id") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", operation(code).alias("op"))


@query("SELECT o_orderkey, (o_orderdate::DATE - INTERVAL 1 DAY)::DATE::VARCHAR AS moved, o_orderdate::DATE::VARCHAR AS kept FROM orders")
def shifted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch days as the source writes them, moved back by its clock's 8 hours and not."""
    days = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.shifted_date(days, 8).cast("string").alias("moved"), fn.shifted_date(days).cast("string").alias("kept"))


@query("SELECT event_id, epoch_us(ts) // 1000 - 28800000 AS ms FROM events")
def shifted_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", fn.update_ms(F.col("ts")).alias("ms"))
    return e.select("event_id", F.unix_millis(fn.shifted_timestamp(F.col("ms"))).alias("ms"))


@query("SELECT o_orderkey, epoch_ms(o_orderdate::DATE::TIMESTAMP) AS of_date, o_orderkey::BIGINT AS of_number FROM orders")
def epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.epoch_ms(F.col("o_orderdate").cast("date"), "date").alias("of_date"), fn.epoch_ms(F.col("o_orderkey"), "bigint").alias("of_number"))


@query("SELECT o_orderkey, year(o_orderdate)::INT AS p_y, month(o_orderdate)::INT AS p_m, day(o_orderdate)::INT AS p_d FROM orders")
def partition_ymd_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "orders").select("o_orderkey", *fn.partition_values(text, is_text=True))


@query(PARTS_SQL + "SELECT l_orderkey, l_linenumber, l_shipdate FROM l SEMI JOIN d USING (p_y, p_m)")
def rows_of_duplicate_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of flagged partitions by a predicate that names each of them."""
    rows = by_month(spark, sf_dir)
    found = repair.duplicate_partitions(rows, F.struct(*LINE_KEYS), ["p_y", "p_m"]).select("p_y", "p_m").collect()  # a row for each partition
    return rows.where(fn.partition_predicate([r.asDict() for r in found])).select(*LINE_KEYS, "l_shipdate")


@query("SELECT DISTINCT year(l_shipdate)::INT AS p_y, month(l_shipdate)::INT AS p_m FROM lineitem WHERE year(l_shipdate) = 1996 AND month(l_shipdate) > 6")
def listed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.partitions(by_month(spark, sf_dir), ["p_y", "p_m"], "p_y = 1996 and p_m > 6")


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 9 <> 0")
def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages as files of a stream; those that can't be read drop out."""
    folder = new_path(spark, "queue")
    e = table(spark, sf_dir, "events")
    task = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("tbl"), F.col("value").cast("string").alias("filePath"))
    e.select(F.when(F.col("event_id") % 9 == 0, F.lit("{broken")).otherwise(F.to_json(task)).alias("value")).repartition(3).write.text(f"{folder}/in")
    stream = tasks.decode(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in"), "value")
    query_ = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query_.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.col("id").cast("bigint").alias("event_id"), F.col("tbl").alias("event_type"), F.col("filePath").cast("double").alias("value"))


@query("SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def joined_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(fn.joined(F.array_sort(F.collect_list("n_name")), "|").alias("names"))


@query("SELECT count(*) AS tasks, count(*) AS ids FROM events")
def task_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of new tasks are all different."""
    e = table(spark, sf_dir, "events").select(F.lit("db").alias("db"), F.col("event_type").alias("table_name"), F.lit("p").alias("partition_name"), F.col("event_id").cast("string").alias("file_path"), F.lit("a").alias("op"))
    return tasks.new_tasks(e).agg(F.count(F.lit(1)).alias("tasks"), F.countDistinct("id").alias("ids"))


@query(LEDGER_SQL + "SELECT table_name, count(*) FILTER (status = 'SUCCESS') AS finished, count(*) AS total, count(*) FILTER (status = 'SUCCESS') / count(*) AS ratio FROM t GROUP BY 1")
def task_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.progress(ledger(spark, sf_dir), ["table_name"])


@query(LEDGER_SQL + "SELECT id, CASE WHEN id LIKE '%7' THEN 'DELAY' ELSE status END AS status, attempt + CASE WHEN id LIKE '%7' THEN 1 ELSE 0 END AS attempt FROM t WHERE id NOT LIKE '%3'")
def ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some tasks are delayed once more, others end and leave the ledger."""
    rows = ledger(spark, sf_dir).withColumn("update_time", F.col("create_time"))
    after = tasks.with_status(rows, rows.where("id like '%7'").select("id"), tasks.DELAY)
    return tasks.with_status(after, rows.where("id like '%3'").select("id"), tasks.SUCCESS, delete=True).select("id", "status", "attempt")


@query(LEDGER_SQL + """, n AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY id) - 1 AS turn, 'db/' || table_name || '/' || partition_name AS place FROM t)
SELECT id, (CASE WHEN status = 'DELAY' THEN ('0x' || md5(place)[1:8])::BIGINT % 7 ELSE turn % 7 END)::INT AS processor FROM n""")
def dealt_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.dealt(ledger(spark, sf_dir), 7).select("id", "processor")


@query("WITH f AS (SELECT 'f' || p_partkey AS file_path FROM part) SELECT file_path, floor((row_number() OVER (ORDER BY md5(file_path), file_path) - 1) / ceil((SELECT count(*) FROM f) / 6))::INT AS chunk FROM f")
def chunked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "part").select(F.concat(F.lit("f"), "p_partkey").alias("file_path"))
    return files.chunks(listed, 6)


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS p_name, p_size FROM part")
def unioned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two staged folders read as one batch, the second without a column."""
    folder, part = new_path(spark, "staged"), table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    part.where("p_partkey % 2 = 0").write.parquet(f"{folder}/a")
    part.where("p_partkey % 2 <> 0").drop("p_name").write.parquet(f"{folder}/b")
    return files.staged(spark, f"{folder}/a", f"{folder}/b").select("p_partkey", "p_name", "p_size")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of staged files at some depth, read back from its JSON lines."""
    folder, nation = new_path(spark, "dump"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nation.write.parquet(f"{folder}/deep/er")
    return files.dump(spark, folder).select(F.from_json("json", nation.schema).alias("r")).select("r.*")


COLUMNS = [("Id", "int"), ("shop_id", "int"), ("name", "varchar"), ("Create_Time", "datetime")]


@query("SELECT * FROM (VALUES ('Id', 'int'), ('shop_id', 'int')) v(name, type)")
def primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.primary_keys(spark.createDataFrame(COLUMNS, "name string, type string"), spark.createDataFrame([("SHOP_ID",), ("id",)], "name string"))


@query(
    "SELECT 'shop.orders' AS name, 'CREATE TABLE IF NOT EXISTS `shop`.`orders` (`create_time` timestamp, `id` bigint, `name` string, `shop_id` bigint) USING orc PARTITIONED BY (p_y INT, p_m INT, p_d INT)' AS statement"
)
def ddl_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of one database stand for it; a table without a create time is left out."""
    catalog = [(db, "orders", n, t) for db in ("shop1", "shop2") for n, t in COLUMNS] + [("shop1", "plain", "id", "int")]
    made = ddl.statements(spark.createDataFrame(catalog, "db string, table string, name string, type string"))
    return spark.createDataFrame(list(made.items()), "name string, statement string")


@query(VIEW + "SELECT 'db.events_' || event_type AS scope, epoch_us(max(ts)) // 1000 AS stream_update_time, CASE WHEN event_type = 'error' THEN 77 ELSE -1 END::BIGINT AS check_update_time FROM events GROUP BY event_type")
def check_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max(fn.update_ms(F.col("ts"))).alias("stream_update_time"))
    at = e.select(F.concat(F.lit("db.events_"), "event_type").alias("scope"), "stream_update_time", F.lit(None).cast("bigint").alias("check_update_time"))
    return marks.set_check_time(spark, marks.advanced(at, at.withColumn("stream_update_time", F.lit(5).cast("bigint"))), [marks.scope("db", "events", "error")], 77).fillna(-1)


@query(VIEW + "SELECT seq, user_id, 'insert' AS action FROM b2")
def blind_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only without looking at the index: every row is appended."""
    one, two = batches(spark, sf_dir)
    return m.actions(two, _index(one), KEYS, m.Policy("insert_only", check_exists=False)).select("seq", "user_id", "action")


@query(VIEW + "SELECT max(ut) AS mark FROM b2")
def insert_only_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are skipped count too."""
    one, two = batches(spark, sf_dir)
    acted = m.actions(two, _index(one), KEYS, m.INSERT_ONLY)
    return m.high_water_marks(acted, [], policy=m.INSERT_ONLY)


@query("SELECT event_type, count(*) AS n, quantile_disc(value, 0.5) AS half, quantile_disc(value, 0.99) AS most FROM events GROUP BY 1")
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.operation_metrics(table(spark, sf_dir, "events"), ["event_type"], latency="value")
    return rows.select("event_type", "n", F.get("latency", F.lit(0)).alias("half"), F.get("latency", F.lit(2)).alias("most"))


@query("SELECT event_type, count(*) AS n, q, true AS within FROM events, (VALUES (0.5::DOUBLE), (0.9), (0.99)) v(q) GROUP BY event_type, q")
def latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each type and day, stored batch by batch, merged on read: quantiles whose rank is as near as promised."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("day"), "value")
    folder, ranks = new_path(spark, "sketches"), [0.5, 0.9, 0.99]
    for part in range(4):
        metrics.latency_sketches(e.where(F.pmod("event_id", F.lit(4)) == part), ["event_type", "day"], "value").write.mode("append").parquet(folder)
    found = metrics.latency_quantiles(metrics.merged_sketches(spark.read.parquet(folder), ["event_type"]), ranks)
    asked = found.select("event_type", F.posexplode("latency").alias("k", "x")).withColumn("q", F.element_at(F.array(*[F.lit(q) for q in ranks]), F.col("k") + 1))
    below = e.join(F.broadcast(asked), "event_type").groupBy("event_type", "q").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("value") < F.col("x")).cast("int")).alias("low"), F.avg((F.col("value") <= F.col("x")).cast("int")).alias("high"))
    within = (F.col("low") <= F.col("q") + metrics.RANK_ERROR) & (F.col("high") >= F.col("q") - metrics.RANK_ERROR)
    return below.select("event_type", "n", "q", within.alias("within"))


@query(VIEW + "SELECT user_id, ut, op <> 'd' AS live FROM w1 WHERE user_id NOT IN (SELECT user_id FROM a WHERE action NOT LIKE 'skip%') UNION ALL SELECT user_id, ut, action IN ('insert', 'update') FROM a WHERE action NOT LIKE 'skip%'")
def bucketed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index that two merges leave in its buckets, which a batch's rows come to."""
    index = BucketedIndex(Store(spark, new_path(spark, "store")), KEYS, buckets=8)
    for k, batch in enumerate(batches(spark, sf_dir)):
        index.merge(batch, batch_id=f"b{k}")
    return index.read().select("user_id", "ut", "live")


@query(VIEW + "SELECT user_id, ut, seq, action FROM a")
def bucketed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second batch does to an index in buckets; merged once more, nothing."""
    index = BucketedIndex(Store(spark, new_path(spark, "store")), KEYS, buckets=8)
    one, two = batches(spark, sf_dir)
    index.merge(one, batch_id="b1")
    acted = index.merge(two, batch_id="b2")
    return acted.unionByName(index.merge(two, batch_id="b2")).select("user_id", "ut", "seq", "action")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE year(l_shipdate) = 1995 AND month(l_shipdate) BETWEEN 2 AND 4")
def pruned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on partition columns reads the folders that it chooses alone."""
    store = Store(spark, new_path(spark, "pruned"), ["p_y", "p_m"])
    rows = by_month(spark, sf_dir).select(*LINE_KEYS, "l_shipdate", "p_y", "p_m")
    store.commit({"rows": rows}, {"rows": rows.select("p_y", "p_m")})
    return store.read("rows", predicate="p_y = 1995 and p_m between 2 and 4").select(*LINE_KEYS, "l_shipdate")


def queries() -> dict[str, Query]:
    return {name: q for name, (q, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _found.items() if sql}

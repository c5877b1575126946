"""The task ledger: id, db, table_name, partition_name, file_path, op, status, attempt, update_time, create_time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEW, PROCESSING, FAIL, SUCCESS, DELAY = "NEW", "PROCESSING", "FAIL", "SUCCESS", "DELAY"
TASK_MESSAGE = "id string, db string, tbl string, partitions array<string>, partitionName string, filePath string, op string, retryCount int, lastUpdateTime bigint, attempt int"
GREEDY, MOST_ATTEMPTS, DELAY_HOURS = 5, 3, 1


def new_tasks(files: DataFrame) -> DataFrame:
    """Ledger rows for staged files (db, table_name, partition_name, file_path, op)."""
    return files.select(F.uuid().alias("id"), "db", "table_name", "partition_name", "file_path", "op", F.lit(NEW).alias("status"), F.lit(0).alias("attempt"), F.current_timestamp().alias("update_time"), F.current_timestamp().alias("create_time"))


def delayed(ledger: DataFrame, now: Column, hours: int = DELAY_HOURS, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """New and delayed tasks that are old enough to be tried again, oldest id first."""
    due = F.col("status").isin(NEW, DELAY) & (F.col("create_time") <= now - F.expr(f"interval {int(hours)} hours")) & (F.col("attempt") <= attempts)
    return ledger.where(due).orderBy("id")


def greedy(ledger: DataFrame, limit: int = GREEDY) -> DataFrame:
    """Of each partition the first new task and up to limit more, which merge as one batch."""
    order = Window.partitionBy("db", "table_name", "partition_name").orderBy("id")
    return ledger.where(F.col("status") == NEW).withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit + 1)


def dealt(ledger: DataFrame, processors: int) -> DataFrame:
    """The ledger with the processor of each task: new tasks in turn by id, delayed ones of a partition all to one."""
    turn = F.row_number().over(Window.partitionBy("status").orderBy("id")) - 1
    place = F.concat_ws("/", "db", "table_name", "partition_name")
    hashed = F.conv(F.substring(F.md5(place.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return ledger.withColumn("processor", F.when(F.col("status") == DELAY, hashed % processors).otherwise(turn % processors).cast("int"))


def with_status(ledger: DataFrame, done: DataFrame, status: str, delete: bool = False) -> DataFrame:
    """The ledger after tasks (ids in done) ended: with their status, or without them; a delay counts an attempt."""
    if delete:
        return ledger.join(done.select("id"), "id", "left_anti")
    hit = ledger.join(done.select("id", F.lit(True).alias("_hit")), "id", "left")
    hit = hit.withColumn("status", F.when(F.col("_hit"), status).otherwise(F.col("status")))
    hit = hit.withColumn("attempt", F.when(F.col("_hit"), F.col("attempt") + int(status == DELAY)).otherwise(F.col("attempt")))
    return hit.withColumn("update_time", F.when(F.col("_hit"), F.current_timestamp()).otherwise(F.col("update_time"))).select(*ledger.columns)


def encode(tasks: DataFrame) -> DataFrame:
    return tasks.select(F.to_json(F.struct(*tasks.columns)).alias("message"))


def decode(messages: DataFrame, column: str = "message") -> DataFrame:
    """Tasks of JSON messages; those that can't be read drop out."""
    parsed = messages.select(F.from_json(F.col(column), TASK_MESSAGE + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("t"))
    return parsed.where("t._bad is null and t.id is not null").select("t.*").drop("_bad")

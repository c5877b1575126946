"""Staged files, streams and catalogs. Avro and Kafka need their Spark packages, which aren't part of Spark itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import partition_name


def staged(spark: SparkSession, *paths: str, format: str = "parquet", recursive: bool = False) -> DataFrame:
    """Staged files as one batch, with the union of their columns."""
    return spark.read.format(format).option("mergeSchema", True).option("recursiveFileLookup", recursive).load(list(paths))


def staged_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", files_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """A stream of staged files. files_per_trigger bounds a batch; archive: where files go when they are done."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def topic_stream(spark: SparkSession, servers: str, topics: list[str], schema: T.StructType, rows_per_trigger: int | None = None) -> DataFrame:
    """A stream of JSON envelopes from Kafka topics, from the earliest offset on."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
    if rows_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_trigger)
    return reader.load().select(F.from_json(F.col("value").cast("string"), schema).alias("e"), "topic", "partition", "offset").select("e.*", "topic", "partition", "offset")


def stage(rows: DataFrame, path: str, by: list[str], most_rows: int = 100_000) -> DataFrame:
    """Write rows to a new folder of the staging area, by partition, in files of at most most_rows; returns file_path and partition_name of each.

    A file holds all columns, so that it can be read alone.
    """
    copies = [F.col(c).alias(f"_part_{c}") for c in by]
    rows.select("*", *copies).hint("rebalance", *[F.col(f"_part_{c}") for c in by]).write.option("maxRecordsPerFile", most_rows).partitionBy(*[f"_part_{c}" for c in by]).parquet(path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return written.select(F.col("_metadata.file_path").alias("file_path"), partition_name(*[F.col(c) for c in by], names=tuple(by)).alias("partition_name")).distinct()


def chunks(files: DataFrame, cores: int, path: str = "file_path") -> DataFrame:
    """files with the chunk that each is dealt to, 0 to cores - 1: in a shuffled order, ceil(files / cores) of them each."""
    order = Window.orderBy(F.md5(F.col(path).cast("binary")), path)  # a list of files, not rows
    return files.withColumn("chunk", F.floor((F.row_number().over(order) - 1) / F.ceil(F.count(F.lit(1)).over(Window.partitionBy()) / cores)).cast("int"))


def source_catalog(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A source database's columns (db, table, name, type) by JDBC; query gives them under these names, in any case."""
    found = spark.read.format("jdbc").options(url=url, query=query, **options).load()
    return found.toDF(*[c.lower() for c in found.columns]).select("db", "table", "name", "type")


def partitions(table: DataFrame, by: list[str], predicate: str | None = None) -> DataFrame:
    """The partitions of a table, optionally those of a predicate on partition columns."""
    return (table.where(predicate) if predicate else table).select(*by).distinct()


def index_lookup(ids: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Each id's index entry as text; EMPTY where it has none."""
    values = [c for c in index.columns if c != key]
    return ids.join(index, key, "left").select(key, *[F.coalesce(F.col(c).cast("string"), F.lit("EMPTY")).alias(c) for c in values])


def dump(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Staged files under a path, at any depth, as JSON lines."""
    rows = staged(spark, path, format=format, recursive=True)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def primary_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Columns (name, type) that keys (name) names whatever its case, alphabetically with their place."""
    hit = columns.join(keys.select(F.lower("name").alias("_k")), F.lower("name") == F.col("_k"), "left_semi")
    return hit.orderBy(F.lower("name"))

"""Scalar functions as Column expressions; none is a UDF."""

from cdclake.functions.keys import business_key, business_key_salted, java_string_hash, joined, split_record_id
from cdclake.functions.partitions import partition_name, partition_predicate, partition_values, parse_partition_name
from cdclake.functions.times import epoch_ms, shifted_date, shifted_timestamp, update_ms, wall_clock
from cdclake.functions.types import sql_type, widen, widened_schema

__all__ = [
    "business_key",
    "business_key_salted",
    "epoch_ms",
    "java_string_hash",
    "joined",
    "parse_partition_name",
    "partition_name",
    "partition_predicate",
    "partition_values",
    "shifted_date",
    "shifted_timestamp",
    "split_record_id",
    "sql_type",
    "update_ms",
    "wall_clock",
    "widen",
    "widened_schema",
]

"""Business keys and record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def business_key(*columns: Column | str) -> Column:
    """The key parts joined by `_`; null parts drop out. Joins use the columns themselves, as `1_2`, `3` and `1`, `2_3` look alike here."""
    if not columns:
        raise ValueError("a key has one column at least")
    return F.concat_ws("_", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])


def java_string_hash(text: Column) -> Column:
    """The signed 32-bit polynomial hash (factor 31) of a text of ASCII characters."""
    parts = F.filter(F.split(text, ""), lambda c: c != "")
    unsigned = F.aggregate(parts, F.lit(0).cast("bigint"), lambda h, c: (h * 31 + F.ascii(c)) % F.lit(1 << 32))
    return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned)


def business_key_salted(*columns: Column | str) -> Column:
    """The business key behind its hash's last digit (with sign), for key stores that are split by prefix."""
    key = business_key(*columns)
    return F.concat_ws("_", (java_string_hash(key) % 10).cast("string"), key)


def split_record_id(record_id: Column, separator: str = "_") -> Column:
    """txn, bucket and row of a record id `t_b_r`; null parts where it has another form."""
    parts = F.split(record_id, "\\" + separator if not separator.isalnum() else separator, 3)
    return F.struct(F.get(parts, F.lit(0)).try_cast("bigint").alias("txn"), F.get(parts, F.lit(1)).try_cast("int").alias("bucket"), F.get(parts, F.lit(2)).try_cast("bigint").alias("row_id"))


def joined(values: Column, separator: str = ",") -> Column:
    """The values of an array as one text; null ones drop out."""
    return F.array_join(values.cast("array<string>"), separator)

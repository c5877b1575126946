"""Change envelopes {before, after, op} with a key, to rows of the staged form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions import partition_values
from cdclake.roles import create_column, key_columns, required

READ, CREATE, UPDATE, DELETE, ALL = "r", "c", "u", "d", "a"
CODES = (READ, CREATE, UPDATE, DELETE, ALL)


def operation(code: Column) -> Column:
    """The operation's code in lower case; null where there is no such operation."""
    low = F.lower(code)
    return F.when(low.isin(*CODES), low)


def flatten(events: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """{after, op, key}: of deletes the image before, names in lower case, without null events and bookkeeping key fields."""
    events = events.where(F.col("after").isNotNull() | F.col("before").isNotNull()) if "before" in events.columns else events.where("after is not null")
    op = operation(F.col("op"))
    image = F.when(op == DELETE, F.col("before")).otherwise(F.col("after")) if "before" in events.columns else F.col("after")
    fields = sorted(events.schema["after"].dataType.fieldNames(), key=str.lower)
    events = events.withColumn("_image", image).where("_image is not null")
    defaults = {k.lower(): v for k, v in (defaults or {}).items()}
    after = [F.coalesce(F.col(f"_image.`{f}`"), F.lit(defaults[f.lower()])) if f.lower() in defaults else F.col(f"_image.`{f}`") for f in fields]
    key = [F.col(f"key.`{f}`").alias(f.lower()) for f in key_columns(events.schema["key"].dataType.fieldNames())]
    rest = [c for c in events.columns if c not in ("before", "after", "op", "key", "_image")]
    return events.select(*rest, F.struct(*[a.alias(f.lower()) for a, f in zip(after, fields, strict=True)]).alias("after"), op.alias("op"), F.struct(*key).alias("key"))


def partitioned(rows: DataFrame, source: str | None = None) -> DataFrame:
    """rows with p_y, p_m, p_d of the create column: creates without a value go to today, updates and deletes without one drop out."""
    names = rows.schema["after"].dataType.fieldNames()
    source = source or required(create_column(names), "create time")
    at = F.col(f"after.`{source}`")
    is_text = rows.schema["after"].dataType[source].dataType.simpleString() == "string"
    rows = rows.where(at.isNotNull() | (F.col("op") == CREATE))
    y, m, d = partition_values(at, is_text)
    today = partition_values(F.current_date())
    return rows.select("*", *[F.when(at.isNotNull(), v).otherwise(t).alias(n) for v, t, n in zip((y, m, d), today, ("p_y", "p_m", "p_d"), strict=True)])


def source_database(name: Column, renames: dict[str, str] | None = None) -> Column:
    """The database of a shard such as `orders12`: the letters before the first digits; then renamed where told."""
    base = F.coalesce(F.nullif(F.regexp_extract(name, r"([a-zA-Z\-_]+)([0-9]+)", 1), F.lit("")), name)
    if not renames:
        return base
    return F.coalesce(F.create_map(*[F.lit(x) for pair in renames.items() for x in pair])[base], base)

"""Times as the sources write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the sources' clocks are ahead of UTC, in hours; instants are moved back by it where asked.
SOURCE_OFFSET_HOURS = 8


def shifted_date(epoch_days: Column, offset_hours: int = 0) -> Column:
    """The date of a number of days; an offset moves midnights to the day before."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor((epoch_days * 24 - offset_hours) / 24).cast("int"))


def shifted_timestamp(epoch_ms: Column, offset_hours: int = SOURCE_OFFSET_HOURS) -> Column:
    return F.timestamp_millis(epoch_ms - F.lit(offset_hours * 3_600_000).cast("bigint"))


def wall_clock(zoned: Column) -> Column:
    """The local time of a zoned text, its offset (`+..`, `-..` or `Z`) left out."""
    local = F.regexp_replace(zoned, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.to_timestamp_ntz(F.replace(local, F.lit("T"), F.lit(" ")))


def epoch_ms(at: Column, kind: str = "timestamp") -> Column:
    """A value in ms since 1970 by the wall clock; kind is its type's name: timestamps, dates, and whole numbers as they are."""
    if kind in ("bigint", "int", "smallint", "tinyint", "long"):
        return at.cast("bigint")
    if kind not in ("timestamp", "timestamp_ntz", "date"):
        raise ValueError(f"no time in a {kind}")
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MILLISECOND", epoch, at.cast("timestamp_ntz"))


def update_ms(at: Column, kind: str = "timestamp") -> Column:
    """An update time in ms since 1970 by the wall clock; 0 where there is none."""
    return F.coalesce(epoch_ms(at, kind), F.lit(0).cast("bigint"))

"""Year, month, day partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("p_y", "p_m", "p_d")


def partition_values(at: Column, is_text: bool = False) -> tuple[Column, Column, Column]:
    """p_y, p_m, p_d as integers, without zero padding; is_text: of `yyyy-MM-dd...`, null where it has another form."""
    if is_text:
        parts = [F.substring(at, a, n).try_cast("int") for a, n in ((1, 4), (6, 2), (9, 2))]
    else:
        parts = [F.year(at), F.month(at), F.dayofmonth(at)]
    return tuple(p.cast("int").alias(n) for p, n in zip(parts, PARTITION_COLUMNS, strict=True))


def partition_name(*values: Column, names: tuple[str, ...] = PARTITION_COLUMNS) -> Column:
    """`p_y=2018/p_m=7/p_d=11`."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{n}="), v.cast("string")) for n, v in zip(names, values, strict=True)])


def parse_partition_name(name: Column) -> Column:
    """The values of a partition name as a map."""
    return F.str_to_map(name, F.lit("/"), F.lit("="))


def partition_predicate(partitions: Iterable[dict[str, object]]) -> str:
    """`(p_y=.. and p_m=..) or (..)`, for partition pruning; `false` for no partition. Values are numbers, texts, dates or null."""

    def one(name: str, value: object) -> str:
        if value is None:
            return f"{name} is null"
        if isinstance(value, (int, float)):
            return f"{name}={value}"
        return f"{name}='" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return " or ".join("(" + " and ".join(one(k, v) for k, v in p.items()) + ")" for p in partitions) or "false"

"""Warehouse tables out of source catalogs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions import sql_type
from cdclake.operators.envelope import source_database
from cdclake.roles import create_column

TEMPLATE = "CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({columns}) USING {format} PARTITIONED BY (p_y INT, p_m INT, p_d INT)"


def columns(catalog: DataFrame) -> DataFrame:
    """(db, table, name, type) with the warehouse's names and types, alphabetical by case-blind name."""
    out = catalog.select("db", "table", F.lower("name").alias("name"), sql_type(F.col("type")).alias("type"))
    return out.orderBy("db", "table", "name")


def statements(catalog: DataFrame, tables: Iterable[str] | None = None, include_digits: bool = False, format: str = "orc") -> dict[str, str]:
    """CREATE TABLE for each table that has a create-time column; others are left out.

    Databases named like shards (`orders12`) stand for one, unless include_digits.
    """
    if not include_digits:
        catalog = catalog.withColumn("db", source_database(F.col("db"))).distinct()
    wanted = {t.strip().lower() for t in tables} if tables else None
    by: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for r in columns(catalog).collect():  # a catalog: a row for each column of the source's tables
        if wanted is None or r["table"].lower() in wanted:
            by.setdefault((r["db"], r["table"]), []).append((r["name"], r["type"]))
    out = {}
    for (db, table), fields in by.items():
        if bad := [n for n, t in fields if t is None]:
            raise ValueError(f"{db}.{table}: no type for {', '.join(bad)}")
        if create_column(n for n, _ in fields):
            out[f"{db}.{table}"] = TEMPLATE.format(db=db, table=table, format=format, columns=", ".join(f"`{n}` {t}" for n, t in fields))
    return out


def create_tables(spark: SparkSession, made: dict[str, str]) -> None:
    for db in {name.split(".")[0] for name in made}:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{db}`")
    for statement in made.values():
        spark.sql(statement)

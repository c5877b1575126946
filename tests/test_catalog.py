"""Every query of the catalog against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

from cdclake.plans import catalog
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SMALL}/{name}'")
    return con


def rows(frame):
    names = sorted(frame.columns)
    return sorted(map(repr, frame[names].astype(object).where(frame[names].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, SMALL).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    expected = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake import functions as fn
from cdclake import roles
from cdclake.functions.types import widened_schema
from cdclake.operators.envelope import flatten, partitioned, source_database


def test_roles():
    assert roles.update_column(["id", "LastUpdatedDatetime"]) == "LastUpdatedDatetime"
    assert roles.update_column(["modify_time", "last_update_date"]) == "last_update_date"
    assert roles.update_column(["modify_time", "last_update_date"], use_global=False) == "modify_time"
    assert roles.create_column(["x", "CreatedDatetime"]) == "CreatedDatetime"
    assert roles.create_column(["x"]) is None
    assert roles.key_columns(["Id", "__dbz__physicalTableIdentifier"]) == ["Id"]


def test_keys(spark):
    keys = ["1", "42", "1234567", "a_b_3", "polygenelubricants"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(fn.business_key_salted("k")).collect()
    assert [r[0] for r in got] == ["9_1", "2_42", "4_1234567", "6_a_b_3", "-8_polygenelubricants"]


def test_times(spark):
    one = spark.range(1)
    z = ["2018-07-11T10:00:00+08:00", "2018-07-11T10:00:00Z", "2018-07-11T10:00:00-05:00"]
    got = spark.createDataFrame([(t,) for t in z], "t string").select(fn.wall_clock(F.col("t")).cast("string")).collect()
    assert {r[0] for r in got} == {"2018-07-11 10:00:00"}
    assert str(one.select(fn.shifted_date(F.lit(0), 8)).first()[0]) == "1969-12-31"
    assert str(one.select(fn.shifted_date(F.lit(1))).first()[0]) == "1970-01-02"


def test_types(spark):
    schema = T.StructType([T.StructField("B", T.ArrayType(T.IntegerType())), T.StructField("a", T.DecimalType(10, 2))])
    assert widened_schema(schema).simpleString() == "struct<a:double,b:array<bigint>>"


def test_envelope(spark):
    kind = "before struct<Id: bigint, createdAt: string>, after struct<Id: bigint, createdAt: string>, op string, key struct<Id: bigint, __dbz__t: string>"
    day = "2018-07-11 10:00:00"
    rows = [(None, (1, day), "C", (1, "t")), ((2, day), None, "d", (2, "t")), (None, None, "u", (3, "t")), (None, (4, None), "u", (4, "t")), (None, (5, None), "c", (5, "t"))]
    out = {r.key.id: r for r in partitioned(flatten(spark.createDataFrame(rows, kind))).collect()}
    assert sorted(out) == [1, 2, 5]
    assert (out[1].p_y, out[1].p_m, out[1].p_d, out[1].op) == (2018, 7, 11, "c")
    assert out[2].after.id == 2 and out[5].p_y is not None
    names = spark.createDataFrame([("orders12",), ("plain",)], "d string").select(source_database(F.col("d"), {"orders": "o"})).collect()
    assert [r[0] for r in names] == ["o", "plain"]

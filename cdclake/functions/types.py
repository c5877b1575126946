"""Type widening and source type names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type names and the warehouse's.
SOURCE_TYPES = {
    "tinyint": "bigint",
    "smallint": "bigint",
    "mediumint": "bigint",
    "int": "bigint",
    "varchar": "string",
    "enum": "string",
    "char": "string",
    "text": "string",
    "mediumtext": "string",
    "longtext": "string",
    "decimal": "double",
    "datetime": "timestamp",
}
UNSUPPORTED = ("bit",)


def widened_type(kind: T.DataType, exact_decimals: bool = False) -> T.DataType:
    """Integers to bigint, fractions to double (decimals too, unless exact_decimals); containers element by element."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(kind, T.FloatType) or (isinstance(kind, T.DecimalType) and not exact_decimals):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(widened_type(kind.elementType, exact_decimals), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(widened_type(kind.keyType, exact_decimals), widened_type(kind.valueType, exact_decimals), kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return widened_schema(kind, exact_decimals)
    return kind


def widened_schema(schema: T.StructType, exact_decimals: bool = False) -> T.StructType:
    """The staged schema: widened types, names in lower case and in alphabetical order."""
    fields = [T.StructField(f.name.lower(), widened_type(f.dataType, exact_decimals), f.nullable) for f in schema]
    return T.StructType(sorted(fields, key=lambda f: f.name))


def widen(df: DataFrame, exact_decimals: bool = False) -> DataFrame:
    """df in its staged schema."""
    named = df.toDF(*[c.lower() for c in df.columns])
    return named.select(*[F.col(f.name).cast(f.dataType) for f in widened_schema(df.schema, exact_decimals)])


def sql_type(source: Column) -> Column:
    """The warehouse's type for a source type such as `varchar(32)` or `int(11) unsigned`; null where the warehouse has none (bit).

    What stands behind the name, such as a length or `unsigned`, doesn't count.
    """
    name = F.lower(F.regexp_extract(F.trim(source), r"^[^\s(]*", 0))
    known = F.create_map(*[F.lit(x) for pair in SOURCE_TYPES.items() for x in pair])
    return F.when(~name.isin(*UNSUPPORTED), F.coalesce(known[name], name))

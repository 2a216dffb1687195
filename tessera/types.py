"""Column types by name: SQL type names of imported schemas as Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: Type names and their Spark types.
_SIMPLE: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(),
    "TINYINT": T.ShortType(), "SMALLINT": T.ShortType(), "INT2": T.ShortType(), "UTINYINT": T.ShortType(),
    "INTEGER": T.IntegerType(), "INT": T.IntegerType(), "INT4": T.IntegerType(), "USMALLINT": T.IntegerType(),
    "BIGINT": T.LongType(), "INT8": T.LongType(), "UINTEGER": T.LongType(),
    "HUGEINT": T.DecimalType(38, 0), "UBIGINT": T.DecimalType(20, 0), "UHUGEINT": T.DecimalType(38, 0),
    "REAL": T.FloatType(), "FLOAT": T.FloatType(), "FLOAT4": T.FloatType(),
    "DOUBLE": T.DoubleType(), "DOUBLE PRECISION": T.DoubleType(), "FLOAT8": T.DoubleType(),
    "VARCHAR": T.StringType(), "TEXT": T.StringType(), "CHAR": T.StringType(), "BPCHAR": T.StringType(), "STRING": T.StringType(),
    "UUID": T.StringType(), "BIT": T.StringType(), "JSON": T.StringType(), "JSONB": T.StringType(), "TIME": T.StringType(), "ENUM": T.StringType(),
    "BLOB": T.BinaryType(), "BYTEA": T.BinaryType(), "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMP WITHOUT TIME ZONE": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(), "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "INTERVAL": T.DayTimeIntervalType(),
}

_DECIMAL = re.compile(r"(?:DECIMAL|NUMERIC)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")
_LIST = re.compile(r"(.+)\[\d*\]")


def spark_type(name: str) -> T.DataType:
    """The Spark type of a SQL type name: scalars, DECIMAL(p,s), T[] and T[n], STRUCT(..), MAP(k, v); anything else is text."""
    text = " ".join(name.split())
    upper = text.upper()
    if upper in _SIMPLE:
        return _SIMPLE[upper]
    if m := _LIST.fullmatch(text):
        return T.ArrayType(spark_type(m[1]))
    if m := _DECIMAL.fullmatch(upper):
        return T.DecimalType(int(m[1] or 18), int(m[2] or 0) if m[1] else 3)
    if re.fullmatch(r"(VARCHAR|CHAR|CHARACTER VARYING|CHARACTER|BPCHAR)\s*\(\s*\d+\s*\)", upper):
        return T.StringType()
    if upper.startswith("STRUCT(") and text.endswith(")"):
        return T.StructType([T.StructField(*_field(f)) for f in _parts(text[7:-1])])
    if upper.startswith("MAP(") and text.endswith(")"):
        key, value = _parts(text[4:-1])
        return T.MapType(spark_type(key), spark_type(value))
    return T.StringType()


def _parts(text: str) -> list[str]:
    """``text`` cut at the commas that no parentheses enclose."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def _field(text: str) -> tuple[str, T.DataType]:
    name, _, kind = text.partition(" ")
    return name.strip('"'), spark_type(kind)


def struct_type(columns: dict[str, str]) -> T.StructType:
    """A schema from column names and SQL type names."""
    return T.StructType([T.StructField(n, spark_type(t)) for n, t in columns.items()])

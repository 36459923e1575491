"""Struct types from short text, without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()), "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def columns(text: str) -> T.StructType:
    """``"a long, b string"`` as a struct type."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in text.split(", "))])

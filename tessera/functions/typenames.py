"""Type names used by inference, merging and the type map."""

from __future__ import annotations

from pyspark.sql import types as T

# Inference tries these in order; the first that every
# non-blank value passes is the column's type, otherwise it is string.
CANDIDATES = ("integer", "long", "double", "timestamp", "boolean")

# Numeric precedence for merging two inferred types
# (a wider type absorbs a narrower one; timestamp sits at the top).
NUMERIC_PRECEDENCE = ("byte", "short", "integer", "long", "float", "double", "timestamp")

_BY_NAME = {
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def spark_type(name: str, timestamp_ntz: bool = False) -> T.DataType:
    if name == "timestamp" and timestamp_ntz:
        return T.TimestampNTZType()
    return _BY_NAME[name]


def type_key(dtype: T.DataType) -> str:
    """Name used to look a Spark type up in the type map."""
    if isinstance(dtype, T.TimestampNTZType):
        return "timestamp"
    return dtype.typeName()

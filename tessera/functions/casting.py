"""Typed casts of string columns under the exact text rules of the JVM parsers.

Spark's casts accept more spellings than ``Integer.parseInt``,
``Double.parseDouble``, ``Boolean.parseBoolean``, ``Timestamp.valueOf`` and
``Date.valueOf`` (trimmed integers, ``t``/``yes`` booleans, a bare ``2017`` as a
timestamp, lower-case ``nan``/``inf``).  Each candidate type therefore gets a
guard expression; the conversion itself is Spark's ``try_cast`` family, so the
whole cast stays a single codegen'd column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.lenient import Lenient, lenient_matches, lenient_timestamp

# Text shapes the JVM parsers accept.
INT_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TIMESTAMP_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?\s*$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
# The JVM floating-point literal: optional blanks and sign, then NaN,
# Infinity, a decimal or a hexadecimal (binary exponent) number with an
# optional f/F/d/D suffix.  Spark's cast also takes nan / inf / infinity in
# any case; this pattern does not.
JVM_FLOAT_TEXT = (
    r"^\s*[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)\s*$"
)
BOOLEAN_WORDS = ("true", "false")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_UNSUPPORTED = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.CalendarIntervalType)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_supported(dtype: T.DataType, name: str = "") -> None:
    """Binary and nested types have no string form to cast from."""
    if isinstance(dtype, _UNSUPPORTED) or not isinstance(
        dtype,
        _INTEGRAL + _FLOATING + (T.BooleanType, T.DecimalType, T.TimestampType, T.TimestampNTZType,
                                 T.DateType, T.StringType),
    ):
        raise TypeError(f"Unsupported data type: {dtype.typeName()} for field {name!r}")


def parses_as(v: Column | str, dtype: T.DataType, date_format: str | None = None) -> Column:
    """True when the (non-null) text is accepted by the JVM parser of ``dtype``."""
    v = _as_col(v)
    check_supported(dtype)
    if isinstance(dtype, _INTEGRAL):
        return v.rlike(INT_TEXT) & v.try_cast(dtype).isNotNull()
    if isinstance(dtype, _FLOATING):
        # The pattern is the whole test: every JVM literal parses (overflow
        # gives an infinity), and no text reaches a failing cast.
        return v.rlike(JVM_FLOAT_TEXT)
    if isinstance(dtype, T.BooleanType):
        return F.lower(v).isin(*BOOLEAN_WORDS)
    if isinstance(dtype, T.DecimalType):
        plain = F.regexp_replace(v, ",", "")
        # A number with more whole digits than the type holds does not parse;
        # digits after its scale are rounded half up.
        return plain.rlike(DECIMAL_TEXT) & plain.try_cast(dtype).isNotNull()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(date_format, Lenient):
            return lenient_matches(v, date_format)
        if date_format:
            return F.try_to_timestamp(v, F.lit(date_format)).isNotNull()
        return v.rlike(TIMESTAMP_TEXT) & v.try_cast(T.TimestampNTZType()).isNotNull()
    if isinstance(dtype, T.DateType):
        return v.rlike(DATE_TEXT) & v.try_cast(T.DateType()).isNotNull()
    return F.lit(True)


def convert(v: Column | str, dtype: T.DataType, date_format: str | None = None) -> Column:
    """The typed value of a text that ``parses_as`` accepted (null on overflow)."""
    v = _as_col(v)
    if isinstance(dtype, _INTEGRAL + _FLOATING):
        return v.try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lower(v) == F.lit("true")
    if isinstance(dtype, T.DecimalType):
        # Thousands separators are dropped before the decimal is read.
        return F.regexp_replace(v, ",", "").try_cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(date_format, Lenient):
            return lenient_timestamp(v, date_format).cast(dtype)
        if date_format:
            return F.try_to_timestamp(v, F.lit(date_format)).cast(dtype)
        return v.try_cast(dtype)
    if isinstance(dtype, T.DateType):
        return v.try_cast(dtype)
    return v


def cast_value(
    v: Column | str,
    dtype: T.DataType,
    nullable: bool = True,
    date_format: str | None = None,
    on_error: str = "raise",
    encode: bool = False,
    name: str = "",
) -> Column:
    """Cast one string column to ``dtype``.

    ``""`` in a nullable non-string column is null; null stays null; a text
    the JVM parser would refuse raises (``on_error="raise"``) or gives null
    (``on_error="null"``).  String columns pass through, URL-encoded when
    ``encode`` is set.  A ``date_format`` is strict, a ``Lenient`` one rolls over.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    v = _as_col(v)
    check_supported(dtype, name)
    if isinstance(dtype, T.StringType):
        return F.url_encode(v) if encode else v
    typed_null = F.lit(None).cast(dtype)
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit(f"cannot cast field {name!r} to {dtype.simpleString()}: "), v))
    else:
        bad = typed_null
    out = F.when(v.isNull(), typed_null)
    if nullable:
        out = out.when(v == F.lit(""), typed_null)
    return out.when(parses_as(v, dtype, date_format), convert(v, dtype, date_format)).otherwise(bad.cast(dtype))


def cast_columns(
    df: DataFrame,
    schema: T.StructType,
    date_format: str | None = None,
    on_error: str = "raise",
    encode_fields: str | list[str] | None = None,
) -> DataFrame:
    """Cast the string columns of ``df`` named by ``schema`` to its types."""
    enc = _field_list(encode_fields)
    return df.select(
        *[
            cast_value(F.col(f.name), f.dataType, f.nullable, date_format, on_error, f.name in enc, f.name).alias(f.name)
            for f in schema.fields
        ]
    )


def url_encode_fields(df: DataFrame, fields: str | list[str]) -> DataFrame:
    """URL-encode (UTF-8, form encoding) the listed string fields."""
    enc = _field_list(fields)
    return df.select(*[F.url_encode(F.col(c)).alias(c) if c in enc else F.col(c) for c in df.columns])


def _field_list(fields: str | list[str] | None) -> set[str]:
    if not fields:
        return set()
    if isinstance(fields, str):
        return set(fields.split(","))
    return set(fields)

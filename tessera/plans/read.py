"""Read plan for string-map records: header -> schema -> typed rows.

Schema choice, first match wins: the user's schema; no records gives an
empty schema; inferred types; every discovered field as a nullable string.
Header discovery and inference are one small aggregate each; rows are built
lazily as column expressions over the distributed records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.functions.typenames import spark_type
from tessera.operators.infer import infer_schema, record_schema_rows
from tessera.sources.records import field_text, header_names, rows_from_records, string_schema


def choose_schema(
    df: DataFrame,
    rec: str = "rec",
    schema: T.StructType | None = None,
    infer: bool = False,
    header_mode: str = "union",
    date_format: str | None = None,
    sample_size: int | None = None,
    order_by: list | None = None,
    timestamp_ntz: bool = True,
) -> T.StructType:
    if schema is not None:
        return schema
    if infer and sample_size is None:
        # Header and types from one grouped pass over the exploded records.
        pairs = record_schema_rows(df, rec, date_format, header_mode)
        return T.StructType([T.StructField(n, spark_type(t, timestamp_ntz), True) for n, t in pairs])
    names = header_names(df, rec, header_mode)
    if not names:
        return T.StructType([])
    if infer:
        cols = {n: field_text(rec, n, None) for n in names}
        return infer_schema(df, cols, date_format, sample_size, order_by, timestamp_ntz)
    return string_schema(names)


def read_records(
    df: DataFrame,
    rec: str = "rec",
    schema: T.StructType | None = None,
    infer: bool = False,
    header_mode: str = "union",
    date_format: str | None = None,
    sample_size: int | None = None,
    order_by: list | None = None,
    encode_fields: str | list[str] | None = None,
    on_error: str = "raise",
    missing: str | None = "",
    timestamp_ntz: bool = True,
) -> DataFrame:
    """Typed DataFrame from a column of string-map records."""
    chosen = choose_schema(df, rec, schema, infer, header_mode, date_format, sample_size, order_by, timestamp_ntz)
    return rows_from_records(df, chosen, rec, date_format, on_error, encode_fields, missing)

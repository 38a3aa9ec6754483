"""Map-shaped records (``MAP<STRING,STRING>``) to typed rows.

Services return records as string maps whose key sets may differ per record.
Here the records are a distributed column ``rec``; header discovery and row
building are column expressions and one small aggregate, never a driver list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.casting import cast_value


def to_records(df: DataFrame, columns: list[str] | None = None, rec: str = "rec",
               keep: list[str] | None = None, drop_blank: bool = True) -> DataFrame:
    """Turn typed columns into one string-map column, the shape exports arrive in.

    Null values (and, with ``drop_blank``, empty strings) leave their key out,
    which gives ragged records.
    """
    cols = columns or df.columns
    kv = []
    for c in cols:
        kv += [F.lit(c), F.col(c).cast("string")]
    m = F.create_map(*kv)
    if drop_blank:
        m = F.map_filter(m, lambda k, v: v.isNotNull() & (v != F.lit("")))
    else:
        m = F.map_filter(m, lambda k, v: v.isNotNull())
    return df.select(*[F.col(k) for k in (keep or [])], m.alias(rec))


# Most distinct field names of a header.
MAX_NAMES = 100_000


def bounded_names(keys: DataFrame, name: str, max_names: int = MAX_NAMES) -> DataFrame:
    """``keys`` with the 0-based ``position`` of each by name.

    Names that are data (ids as keys) would make the header as long as the table:
    one name more than ``max_names`` raises, and no more than that reach the task
    that sorts them."""
    many = F.raise_error(F.lit(f"more than {max_names} distinct field names: keys that are data make no header"))
    row = F.row_number().over(Window.orderBy(name)) - 1
    return keys.limit(max_names + 1).withColumn("position", F.when(row >= max_names, many.cast("int")).otherwise(row).cast("int"))


def discover_header(df: DataFrame, rec: str = "rec", mode: str = "union", max_names: int = MAX_NAMES) -> DataFrame:
    """Field names of the records as rows ``(position, name)``; more than
    ``max_names`` raise.

    ``union``: every key seen in any record, sorted (a distinct aggregate with
    map-side combine).  ``widest``: the key set of the record with the most
    keys, ties broken by the larger sorted key list, so the answer does not
    depend on partitioning.
    """
    if mode == "union":
        keys = df.select(F.explode(F.map_keys(F.col(rec))).alias("name")).distinct()
        return bounded_names(keys, "name", max_names).select("position", "name")
    if mode == "widest":
        # The largest (key count, sorted keys) pair: one key sort per record.
        pair = F.struct(F.size(F.col(rec)).alias("n"), F.array_sort(F.map_keys(F.col(rec))).alias("k"))
        best = df.agg(F.max(pair).alias("best")).select(F.col("best.k").alias("k"))
        many = F.raise_error(F.lit(f"more than {max_names} field names in one record"))
        best = best.select(F.when(F.size("k") > max_names, many.cast("array<string>")).otherwise(F.col("k")).alias("k"))
        return best.select(F.posexplode("k").alias("position", "name")).select(
            F.col("position").cast("int"), "name"
        )
    raise ValueError("mode must be 'union' or 'widest'")


def header_names(df: DataFrame, rec: str = "rec", mode: str = "union", max_names: int = MAX_NAMES) -> list[str]:
    """The discovered header on the driver (``max_names`` at most)."""
    rows = discover_header(df, rec, mode, max_names).orderBy("position").collect()
    return [r["name"] for r in rows]


def field_text(rec: Column | str, name: str, missing: str | None = "") -> Column:
    """Value of ``name`` in the record; an absent key reads as ``missing``."""
    rec = F.col(rec) if isinstance(rec, str) else rec
    if missing is None:
        return rec[name]
    return F.when(F.map_contains_key(rec, F.lit(name)), rec[name]).otherwise(F.lit(missing))


def rows_from_records(
    df: DataFrame,
    schema: T.StructType,
    rec: str = "rec",
    date_format: str | None = None,
    on_error: str = "raise",
    encode_fields: str | list[str] | None = None,
    missing: str | None = "",
    keep: list[str] | None = None,
) -> DataFrame:
    """Typed columns from the records, by field name.

    An absent key reads as ``""`` before casting (so it is null in a
    nullable non-string column and ``""`` in a string column); an explicit
    null stays null.
    """
    enc = set(encode_fields.split(",")) if isinstance(encode_fields, str) else set(encode_fields or [])
    cols = [
        cast_value(field_text(rec, f.name, missing), f.dataType, f.nullable, date_format, on_error,
                   f.name in enc, f.name).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*[F.col(k) for k in (keep or [])], *cols)


def string_schema(names: list[str]) -> T.StructType:
    """Every field a nullable string: the schema when inference is off."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])

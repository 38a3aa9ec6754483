"""Schema inference from string values in one aggregate pass.

Each non-blank value gets the class of the first candidate it parses as:
0 integer, 1 long, 2 double, 3 timestamp, 4 boolean, 5 none (one CASE that
stops at the first hit).  Integer, long and double form a chain (every
integer text is a long text is a double text) and the other classes are
disjoint, so "the first candidate every value passes" is: the largest
class when all values are numeric; timestamp when all values are
timestamps; boolean when all are booleans; string otherwise; and string
(or ``empty_as``) when no value is seen.  Per column that is ``min`` and
``max`` of the class -- algebraic aggregates with partial aggregation, so
the pass is map-side combined and the answer does not depend on how rows
are partitioned or ordered.  Only the small (column, type) table reaches
the driver, and only when a ``StructType`` is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.casting import INT_TEXT, parses_as
from tessera.functions.typenames import CANDIDATES, NUMERIC_PRECEDENCE, spark_type
from tessera.sources.records import MAX_NAMES, bounded_names, header_names

_NONE = len(CANDIDATES)


def _columns(df: DataFrame, columns) -> list[tuple[str, Column]]:
    if columns is None:
        return [(c, F.col(c)) for c in df.columns]
    if isinstance(columns, Mapping):
        return [(k, v if isinstance(v, Column) else F.col(v)) for k, v in columns.items()]
    return [(c, F.col(c)) for c in columns]


def _sampled(df: DataFrame, sample_size: int | None, order_by) -> DataFrame:
    if sample_size is None:
        return df
    if not order_by:
        raise ValueError("a sample needs order_by so that the same rows are taken every time")
    # Top-n by a declared order: a bounded per-partition top-k, then a merge.
    return df.orderBy(*order_by).limit(sample_size)


def value_class(v: Column, date_format: str | None = None) -> Column:
    """Class of one value (null when blank): index of the first candidate it parses as.

    The integer text pattern is tested once: a text that has it is an
    integer, else a long, else (out of long range) still a double, since
    every integer text is a JVM floating literal."""
    integral = (
        F.when(parses_as(v, spark_type("integer")), F.lit(0))
        .when(v.try_cast(T.LongType()).isNotNull(), F.lit(1))
        .otherwise(F.lit(2))
    )
    return (
        F.when(v.isNull() | (v == F.lit("")), F.lit(None).cast("int"))
        .when(v.rlike(INT_TEXT), integral)
        .when(parses_as(v, spark_type("double")), F.lit(2))
        .when(parses_as(v, spark_type("timestamp"), date_format), F.lit(3))
        .when(parses_as(v, spark_type("boolean")), F.lit(4))
        .otherwise(F.lit(_NONE))
    )


def class_cols(v: Column, prefix: str, date_format: str | None = None) -> list[Column]:
    """The class of each value as a column of its own, so that ``min`` and
    ``max`` read a number instead of running the tests twice."""
    cols = [value_class(v, date_format).alias(f"{prefix}_cls")]
    if date_format:
        # A pattern may also accept numeric texts, so "all timestamps" is its own test.
        ts = parses_as(v, spark_type("timestamp"), date_format)
        cols.append(F.when(v.isNotNull() & (v != F.lit("")), ts).alias(f"{prefix}_is_ts"))
    return cols


def class_aggs(prefix: str, date_format: str | None = None) -> list[Column]:
    aggs = [F.min(f"{prefix}_cls").alias(f"{prefix}_lo"), F.max(f"{prefix}_cls").alias(f"{prefix}_hi")]
    if date_format:
        aggs.append(F.bool_and(f"{prefix}_is_ts").alias(f"{prefix}_ts"))
    return aggs


def type_of_classes(prefix: str, date_format: str | None = None, empty_as: str | None = "string") -> Column:
    lo, hi = F.col(f"{prefix}_lo"), F.col(f"{prefix}_hi")
    numeric = None
    for i in range(3):
        numeric = F.when(hi == F.lit(i), F.lit(CANDIDATES[i])) if numeric is None else numeric.when(
            hi == F.lit(i), F.lit(CANDIDATES[i]))
    all_ts = F.coalesce(F.col(f"{prefix}_ts"), F.lit(False)) if date_format else (lo == F.lit(3)) & (hi == F.lit(3))
    return (
        F.when(hi.isNull(), F.lit(empty_as).cast("string"))
        .when(hi <= F.lit(2), numeric)
        .when(all_ts, F.lit("timestamp"))
        .when((lo == F.lit(4)) & (hi == F.lit(4)), F.lit("boolean"))
        .otherwise(F.lit("string"))
    )


def infer_types(
    df: DataFrame,
    columns=None,
    date_format: str | None = None,
    sample_size: int | None = None,
    order_by: list | None = None,
    by: list[str] | None = None,
    empty_as: str | None = "string",
) -> DataFrame:
    """``(position, column, type)`` per column (and per ``by`` group).

    A column with no non-blank value is ``empty_as`` (string; ``None`` keeps
    it null so that ``merge_types`` lets it yield to other groups)."""
    cols = _columns(df, columns)
    src = _sampled(df, sample_size, order_by)
    # Each value is computed once in a projection, then classified.
    keep = [F.col(b) for b in (by or [])]
    values = src.select(*keep, *[c.alias(f"_v{i}") for i, (_, c) in enumerate(cols)])
    classes, aggs = [], []
    for i in range(len(cols)):
        classes += class_cols(F.col(f"_v{i}"), f"_c{i}", date_format)
        aggs += class_aggs(f"_c{i}", date_format)
    values = values.select(*keep, *classes)
    grouped = values.groupBy(*by).agg(*aggs) if by else values.agg(*aggs)
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"),
                 type_of_classes(f"_c{i}", date_format, empty_as).alias("type"))
        for i, (name, _) in enumerate(cols)
    ]
    return grouped.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.position", "e.column", "e.type")


def infer_record_types(df: DataFrame, rec: str = "rec", date_format: str | None = None,
                       empty_as: str | None = "string", max_names: int = MAX_NAMES) -> DataFrame:
    """Header and types of string-map records in one pass:
    ``(position, column, type)`` for every key seen, keys in sorted order.

    The records are exploded to (key, value) and grouped by key with partial
    aggregation, so each map task sends one row per key; a key absent from
    a record counts as blank there.  More than ``max_names`` keys raise."""
    kv = df.select(F.explode(F.col(rec)).alias("k", "v")).select("k", *class_cols(F.col("v"), "_c", date_format))
    per_key = kv.groupBy("k").agg(*class_aggs("_c", date_format))
    return bounded_names(per_key, "k", max_names).select(
        "position",
        F.col("k").alias("column"),
        type_of_classes("_c", date_format, empty_as).alias("type"),
    )


def record_schema_rows(df: DataFrame, rec: str = "rec", date_format: str | None = None,
                       header_mode: str = "union") -> list[tuple[str, str]]:
    """``(name, type)`` of the header in order: all keys sorted (``union``), or
    the widest record's keys (``widest``, one more pass that looks at each
    record's keys once), typed by every record's values."""
    if header_mode not in ("union", "widest"):
        raise ValueError("header_mode must be 'union' or 'widest'")
    rows = infer_record_types(df, rec, date_format).collect()  # schema width
    types = {r["column"]: r["type"] for r in rows}
    if header_mode == "union":
        return [(r["column"], r["type"]) for r in sorted(rows, key=lambda r: r["position"])]
    return [(k, types[k]) for k in header_names(df, rec, "widest")]


def infer_schema(
    df: DataFrame,
    columns=None,
    date_format: str | None = None,
    sample_size: int | None = None,
    order_by: list | None = None,
    timestamp_ntz: bool = False,
) -> T.StructType:
    """The inferred schema (all fields nullable), in column order."""
    cols = _columns(df, columns)
    if not cols:
        return T.StructType([])
    rows = infer_types(df, columns, date_format, sample_size, order_by).collect()
    by_pos = {r["position"]: r["type"] for r in rows}
    return T.StructType(
        [T.StructField(name, spark_type(by_pos[i], timestamp_ntz), True) for i, (name, _) in enumerate(cols)]
    )


def precedence_rank(t: Column) -> Column:
    out = None
    for i, name in enumerate(NUMERIC_PRECEDENCE):
        out = F.when(t == F.lit(name), F.lit(i)) if out is None else out.when(t == F.lit(name), F.lit(i))
    return out


def merge_types(types: DataFrame, by: list[str] | None = None, type_col: str = "type") -> DataFrame:
    """Tightest common type of several inferred types per ``by`` key.

    Equal types stay; a null (no value seen) yields to the other; two
    numeric-precedence types give the wider; anything else is string; all null
    is string.  Grouped with partial aggregation, so a key with many inputs is
    combined map-side.
    """
    by = by or ["column"]
    t = F.col(type_col)
    rank = precedence_rank(t)
    merged = types.groupBy(*by).agg(
        F.min(t).alias("_lo"),
        F.max(t).alias("_hi"),
        F.bool_and(F.when(t.isNotNull(), rank.isNotNull())).alias("_num"),
        F.max(rank).alias("_rank"),
    )
    wider = None
    for i, name in enumerate(NUMERIC_PRECEDENCE):
        c = F.col("_rank") == F.lit(i)
        wider = F.when(c, F.lit(name)) if wider is None else wider.when(c, F.lit(name))
    result = (
        F.when(F.col("_lo").isNull(), F.lit("string"))
        .when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
        .when(F.col("_num"), wider)
        .otherwise(F.lit("string"))
    )
    return merged.select(*by, result.alias(type_col))

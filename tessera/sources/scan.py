"""Table scans: files Spark can reach stand in for remote datasets and objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
         **options) -> DataFrame:
    """One-shot scan of a dataset; filters and projections above it reach the file reader."""
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def object_scan(
    df: DataFrame,
    columns: list[str] | None = None,
    where: Column | None = None,
    not_null: list[str] | None = None,
    query_all: bool = False,
    deleted: Column | str | None = None,
    deleted_value=True,
) -> DataFrame:
    """Rows of an object query: projection, filters, and deleted rows left out
    unless ``query_all`` (deleted / archived rows included).

    ``deleted`` names the column whose value ``deleted_value`` marks a deleted
    row (a null marks none); the predicate ``isnull(c) OR c <> value`` is on
    the column itself, so it reaches the file reader.  A boolean expression
    may be given instead, but Spark cannot push that one down."""
    out = df
    if deleted is not None and not query_all:
        if isinstance(deleted, str):
            c = F.col(deleted)
            out = out.where(c.isNull() | (c != F.lit(deleted_value)))
        else:
            out = out.where(deleted.isNull() | ~deleted)
    if where is not None:
        out = out.where(where)
    for c in not_null or []:
        out = out.where(F.col(c).isNotNull())
    if columns:
        out = out.select(*columns)
    return out


def csv_source(spark: SparkSession, path: str, header: bool = True, schema: T.StructType | None = None,
               **options) -> DataFrame:
    """CSV files with a header line; every column a string unless a schema is given."""
    reader = spark.read.option("header", str(header).lower()).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def example_rows(df: DataFrame, value: str) -> DataFrame:
    """Four string columns ``v, v+1, v+2, v+3`` per input value (the example table shape)."""
    v = F.col(value).cast("long")
    return df.select(*[(v + F.lit(i)).cast("string").alias(f"c{i + 1}") for i in range(4)])

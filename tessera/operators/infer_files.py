"""Inference kept up over added files: only new files are read.

The classes that inference folds (``operators/infer.py``) are minima and maxima, so
they merge: a table of states keeps, per file and column, the least and the largest
class and whether all values are timestamps by the pattern.  A call reads the files
that have no state yet, or that changed since (size or modification time), appends
their states, and folds the states of the files that are there now.  So the answer is that of a
full pass over all of them, whatever the order in which they came.

The driver holds a name per file, as any scan of them does; states are one small row
per file and column.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.infer import class_aggs, class_cols, type_of_classes

STATES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("_c_lo", T.IntegerType()),
        T.StructField("_c_hi", T.IntegerType()),
        T.StructField("_c_ts", T.BooleanType()),
        T.StructField("date_format", T.StringType()),
    ]
)


def _listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file, length, modified) of the files under ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def _states(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STATES).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STATES)


def infer_added_files(spark: SparkSession, path: str, states: str, columns: list[str], date_format: str | None = None,
                      fmt: str = "csv", glob: str = "*.csv", **options) -> tuple[DataFrame, list[str]]:
    """``(position, column, type)`` over all files under ``path``, and the files that were read for it.

    ``columns`` are read as strings; ``states`` is the folder of the state table.  One
    caller at a time: two would append the same states twice, which changes no answer."""
    known = _states(spark, states).where(F.col("date_format").eqNullSafe(F.lit(date_format)))
    there = _listed(spark, path, glob)
    new = [r["file"] for r in there.join(known.select("file", "length", "modified").distinct(), ["file", "length", "modified"], "left_anti").orderBy("file").collect()]
    if new:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()}).schema(schema)
        rows = reader.load(new).select(F.col("_metadata.file_path").alias("file"), *[F.col(f"`{c}`") for c in columns])
        classes, aggs, entries = [], [], []
        for i, c in enumerate(columns):
            classes += class_cols(F.col(f"`{c}`"), f"_c{i}", date_format)
            aggs += class_aggs(f"_c{i}", date_format)
            ts = F.col(f"_c{i}_ts") if date_format else F.lit(None).cast("boolean")
            entries.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"_c{i}_lo").alias("_c_lo"), F.col(f"_c{i}_hi").alias("_c_hi"), ts.alias("_c_ts")))
        per_file = rows.select("file", *classes).groupBy("file").agg(*aggs).select("file", F.explode(F.array(*entries)).alias("e")).select("file", "e.*")
        # A file without rows has its states, too: nothing seen.
        empty = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column")) for i, c in enumerate(columns)]
        wanted = there.where(F.col("file").isin(new)).select("file", "length", "modified", F.explode(F.array(*empty)).alias("e")).select("file", "length", "modified", "e.*")
        out = wanted.join(per_file, ["file", "position", "column"], "left").withColumn("date_format", F.lit(date_format).cast("string"))
        out.select(*[F.col(f.name).cast(f.dataType) for f in STATES.fields]).coalesce(1).write.mode("append").parquet(states)
    now = _states(spark, states).where(F.col("date_format").eqNullSafe(F.lit(date_format))).join(there, ["file", "length", "modified"], "left_semi")
    folded = now.groupBy("position", "column").agg(F.min("_c_lo").alias("_c_lo"), F.max("_c_hi").alias("_c_hi"), F.bool_and("_c_ts").alias("_c_ts"))
    return folded.select("position", "column", type_of_classes("_c", date_format).alias("type")), new

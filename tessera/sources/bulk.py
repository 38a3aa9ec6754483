"""Bulk CSV batches: write a table as header-led CSV batches, read the
completed batches back as one table.

Every write is a run with a folder of its own: batches live under
``<path>/run=<id>/batch_id=<k>/result=<r>/``, so a batch that is written again
leaves the files of its first writing alone.  ``<path>/_manifest`` is a log; its rows
carry a sequence number that grows with each logging (claimed like a version, so two
loggers never share one).  Of a batch the newest run counts, and of that run's result
files the last state.  Reading keeps only those whose state is ``Completed`` (a
semi join on the partition columns, so Spark prunes the other folders), parses with
Spark's CSV reader (quotes doubled, newlines inside quoted fields), one read per
distinct header and columns matched by name, and then applies the newline rule.
"""

from __future__ import annotations

import csv
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.encode import csv_header
from tessera.operators.parts import MAX_PART_BYTES, gathered, landed_bytes, parted_lines
from tessera.plans import commitlog

# Fixed value: default longest field the bulk parser accepts.
DEFAULT_MAX_CHARS = 4096

MANIFEST = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("result", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("header", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


def write_batches(df: DataFrame, path: str, order_by: list[str], max_bytes: int = MAX_PART_BYTES,
                  columns: list[str] | None = None, job_id: str = "job", results_per_batch: int = 1,
                  split: str = "range", first_batch: int = 1) -> DataFrame:
    """Add ``df`` to ``path`` as CSV batches of at most ``max_bytes`` plus one
    line, every result file led by the header line, and their manifest rows;
    returns the manifest of all batches there.

    A batch's rows may be split over ``results_per_batch`` result files (equal
    byte ranges).  ``split`` as for ``parted_lines``.  Batches are numbered from
    ``first_batch``; a batch number that is there already is replaced, whatever
    its result files and column order were."""
    run = uuid.uuid4().hex
    cols = columns or df.columns
    header = csv_header(cols)
    # Batch files are parsed back by a CSV reader: a \r inside a value is quoted too.
    lines = parted_lines(df, order_by, max_bytes, cols, subparts=results_per_batch, quote_cr=True, split=split)
    lines = lines.withColumn("batch_id", F.col("part_number") + F.lit(first_batch - 1)).withColumnRenamed("subpart", "result")
    led = F.when(F.col("first"), F.concat(F.lit(header + "\n"), F.col("line"))).otherwise(F.col("line"))
    (
        gathered(lines, "batch_id", split)
        .withColumn("line", led)
        # The writer needs rows ordered by its partition columns; keeping them
        # as the sort prefix stops it from re-sorting away the line order.
        .sortWithinPartitions("batch_id", "result", "range_id", "pos")
        .select("batch_id", "result", "line")
        .write.partitionBy("batch_id", "result")
        .text(f"{path}/run={run}")
    )
    # Planned rows and bytes, Completed where all bytes are in the files.
    planned = lines.groupBy("batch_id", "result").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))
    landed = landed_bytes(df.sparkSession, f"{path}/run={run}", ["batch_id", "result"]).select(
        F.col("batch_id").cast("long"), F.col("result").cast("int"), "landed")
    size = F.col("bytes") + F.lit(len(header.encode()) + 1)
    manifest = planned.join(landed, ["batch_id", "result"], "left").select(
        F.lit(job_id).alias("job_id"), "batch_id", "result",
        F.when(F.col("landed") == size, F.lit("Completed")).otherwise(F.lit("Failed")).alias("state"),
        "rows", size.cast("long").alias("bytes"), F.lit(header).alias("header"), F.lit(run).alias("run"), F.lit(None).cast("long").alias("seq"),
    )
    return log_batches(manifest, path)


def log_batches(manifest: DataFrame, path: str) -> DataFrame:
    """Append manifest rows (new batches, or new states of known ones) under the
    next sequence number; returns the whole log."""
    spark = manifest.sparkSession
    try:
        seq = (read_manifest(spark, path).agg(F.max("seq")).first()[0] or 0) + 1
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        seq = 1
    while not commitlog.claim(spark, f"{path}/_log", seq):
        seq += 1
    rows = manifest.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST.fields]).withColumn("seq", F.lit(seq).cast("long"))
    rows.write.mode("append").parquet(f"{path}/_manifest")
    return read_manifest(spark, path)


# Fixed value: the record separator the writers use.  Set on the reader, it
# stops the parser from guessing the separator from the first \r it sees
# (a guess that splits or merges records holding a \r).
RECORD_SEP = "\n"


def csv_options(max_chars: int) -> dict[str, str]:
    """``enforceSchema`` off: Spark then compares a file's header with the
    schema and fails on another order, instead of filling fields by position."""
    return {"header": "true", "multiLine": "true", "lineSep": RECORD_SEP, "quote": '"', "escape": '"',
            "enforceSchema": "false", "maxCharsPerColumn": str(max_chars)}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def current_results(manifest: DataFrame) -> DataFrame:
    """``(batch_id, run, result, state, header)`` of each batch's newest run, at its last state."""
    seq = F.coalesce(F.col("seq"), F.lit(0))
    states = manifest.groupBy("batch_id", "run", "result").agg(F.max_by(F.struct("state", "header"), seq).alias("now"), F.min(seq).alias("begun"))
    runs = states.groupBy("batch_id", "run").agg(F.min("begun").alias("begun"))
    newest = runs.groupBy("batch_id").agg(F.max_by("run", F.struct("begun", "run")).alias("run"))
    return states.join(newest, ["batch_id", "run"]).select("batch_id", "run", "result", "now.state", "now.header")


def completed_batches(manifest: DataFrame, results: str = "all") -> DataFrame:
    """``(batch_id, run, result, header)`` to read: Completed batches only; with
    ``results="last"`` only the last result of each batch."""
    done = current_results(manifest).where(F.col("state") == F.lit("Completed"))
    if results == "last":
        return done.groupBy("batch_id", "run").agg(F.max("result").alias("result"), F.max_by("header", "result").alias("header"))
    if results != "all":
        raise ValueError("results must be 'all' or 'last'")
    return done.select("batch_id", "run", "result", "header")


def header_names(header: str) -> list[str]:
    return next(csv.reader([header]))


def header_schema(header: str | None, schema: T.StructType) -> T.StructType:
    """``schema`` in the header's order (None: no recorded header, the schema's order)."""
    if header is None:
        return schema
    names = header_names(header)
    if sorted(names) != sorted(schema.names):
        raise ValueError(f"batch columns {names} are not those of the schema, {schema.names}")
    return T.StructType([schema[n] for n in names])


# Inferred number types, each holding the values of those before it.
WIDER = [T.IntegerType(), T.LongType(), T.DoubleType()]


def wider_schema(schemas: list[T.StructType]) -> dict[str, T.DataType]:
    """One type per column name: the wider number type, else string where the types differ."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            have = out.setdefault(f.name, f.dataType)
            if have != f.dataType:
                out[f.name] = max(have, f.dataType, key=WIDER.index) if have in WIDER and f.dataType in WIDER else T.StringType()
    return out


def normalize_newlines(df: DataFrame, replacement: str | None = " ", columns: list[str] | None = None) -> DataFrame:
    """``\\r\\n``, ``\\r`` and ``\\n`` inside string fields each become ``replacement``."""
    if replacement is None:
        return df
    targets = set(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.select(
        *[
            F.regexp_replace(F.col(c), r"\r\n?|\n", replacement).alias(c) if c in targets else F.col(c)
            for c in df.columns
        ]
    )


def read_batches(
    spark: SparkSession,
    path: str,
    manifest: DataFrame | None = None,
    schema: T.StructType | None = None,
    infer: bool = False,
    max_chars: int = DEFAULT_MAX_CHARS,
    newline: str | None = " ",
    results: str = "all",
    keep_batch: bool = False,
) -> DataFrame:
    """One table from the completed batches.  Columns are matched by the names
    in a batch's header.  Without a ``schema`` they are those of all headers, in
    order of first appearance (null where a batch lacks one): strings, or with
    ``infer`` what the CSV reader infers from the files of each header, widened to one
    type per name.  A field longer than ``max_chars`` fails the parse (``-1`` for no
    limit)."""
    manifest = manifest if manifest is not None else read_manifest(spark, path)
    wanted = completed_batches(manifest, results)
    reader = spark.read.options(**csv_options(max_chars)).option("basePath", path)
    runs: dict[str | None, list[str]] = {}
    for row in wanted.groupBy("header", "run").agg(F.min("batch_id").alias("b")).orderBy("b", "run").collect():  # one row per write
        runs.setdefault(row["header"], []).append(f"{path}/run={row['run']}")
    keys = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("result", T.IntegerType())]
    key_names = [k.name for k in keys]
    if schema is not None:
        schemas = {h: header_schema(h, schema) for h in runs}
    else:
        schemas = {h: None if h is None else T.StructType([T.StructField(n, T.StringType()) for n in header_names(h)]) for h in runs}
        if infer or None in schemas:
            for h in schemas:
                if infer or schemas[h] is None:  # by the files' own header
                    found = reader.option("inferSchema", str(bool(infer)).lower()).csv(runs[h]).schema
                    schemas[h] = T.StructType([f for f in found.fields if f.name not in key_names])
            types = wider_schema(list(schemas.values()))
            schemas = {h: T.StructType([T.StructField(f.name, types[f.name]) for f in s.fields]) for h, s in schemas.items()}
    rows = None
    for header, fields in schemas.items():
        part = reader.schema(T.StructType(fields.fields + keys)).csv(runs[header])
        part = part.join(wanted.where(F.col("header").eqNullSafe(F.lit(header))), key_names, "left_semi")
        part = part.select(*(schema.names if schema is not None else fields.names), "batch_id", "result")
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None:
        rows = spark.createDataFrame([], T.StructType((schema.fields if schema is not None else []) + keys[1:]))
    if keep_batch:
        rows = rows.select(*[c for c in rows.columns if c not in key_names], "batch_id", "result")
    else:
        rows = rows.drop("batch_id", "result")
    return normalize_newlines(rows, newline)


def length_violations(df: DataFrame, columns: list[str], max_chars: int = DEFAULT_MAX_CHARS,
                      keep: list[str] | None = None) -> DataFrame:
    """``(keep..., column, length)`` for every field longer than ``max_chars``."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.length(F.col(c)).cast("long").alias("length")) for c in columns
    ]
    keep = keep or []
    exploded = df.select(*[F.col(k) for k in keep], F.explode(F.array(*entries)).alias("e"))
    return exploded.select(*keep, "e.column", "e.length").where(F.col("length") > F.lit(max_chars))

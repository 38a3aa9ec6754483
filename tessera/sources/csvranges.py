"""Multi-line CSV read by byte ranges: one large file gives many tasks.

Spark's ``multiLine`` reads a file in one task, since a newline may lie inside quotes.
Here the file is read as text lines, which Spark splits into byte ranges (a line
belongs to the range it begins in), and the record boundaries are found afterwards:

1. A line's quotes toggle the state "inside quotes"; doubled ones toggle it back.  In
   each range the running parity of the quotes tells which lines begin a record if the
   range begins outside quotes, and which do if it begins inside.
2. Per range (one row each) that is the parity of all its quotes; their running parity
   over the ranges of the file picks the beginning that holds.
3. Lines are joined to records inside their range; what is left of a record whose
   beginning lies in an earlier range is sent there (two pieces a range at most).
4. Each record's text is parsed by ``from_csv``.

The lines are shuffled once, by range.  Quotes must be RFC 4180's: around whole fields,
and doubled inside them; then the rows are those of ``multiLine``.  A quoted field may
span any number of ranges, a record has to fit one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SEP = "\n"
_AT = ["_tessera_file", "_tessera_from"]


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, range, record, text)``: the records of CSV files, numbered from 1 in the range they begin in."""
    lines = spark.read.option("lineSep", RECORD_SEP).text(path).select(
        F.col("_metadata.file_path").alias(_AT[0]), F.col("_metadata.file_block_start").alias(_AT[1]),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("_line"),
    )
    quotes = (F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))) % 2
    in_range = Window.partitionBy(*_AT).orderBy("_at")
    # Parity of the quotes before a line, within its range.
    lines = lines.withColumn("_q", quotes).withColumn("_odd", F.coalesce(F.sum("_q").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)

    # One row a range: whether it begins inside quotes, how many records begin in it,
    # and the last range before it in which one does.
    per = lines.groupBy(*_AT).agg((F.sum("_q") % 2).alias("_odd_all"), F.count_if(F.col("_odd") == 0).alias("_n0"), F.count_if(F.col("_odd") == 1).alias("_n1"))
    in_file = Window.partitionBy(_AT[0]).orderBy(_AT[1])
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_inside", F.coalesce(F.sum("_odd_all").over(before), F.lit(0)) % 2)
    per = per.withColumn("_n", F.when(F.col("_inside") == 0, F.col("_n0")).otherwise(F.col("_n1")))
    opened = F.last(F.when(F.col("_n") > 0, F.struct(F.col(_AT[1]).alias("from"), F.col("_n").alias("n"))), ignorenulls=True).over(before)
    per = per.select(*_AT, "_inside", F.col("_n").alias("_n_records"), opened.alias("_opened"))

    known = lines.join(per, _AT)
    begins = F.col("_odd") == F.col("_inside")
    number = F.sum(F.when(begins, 1).otherwise(0)).over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    numbered = known.withColumn("_record", number)
    pieces = numbered.groupBy(*_AT, "_record", "_n_records", "_opened").agg(F.array_sort(F.collect_list(F.struct("_at", "_line"))).alias("_lines"))
    pieces = pieces.withColumn("_text", F.array_join(F.transform("_lines", lambda x: x["_line"]), RECORD_SEP)).drop("_lines")
    # Open to a neighbour: the lines before the range's first record, and its last record.
    head, last = F.col("_record") == 0, F.col("_record") == F.col("_n_records")
    whole = pieces.where(~head & ~last).select(*_AT, "_record", "_text")
    parts = pieces.where(head | last).select(
        _AT[0], F.when(head, F.col("_opened.from")).otherwise(F.col(_AT[1])).alias("_to"), F.when(head, F.col("_opened.n")).otherwise(F.col("_record")).alias("_record"),
        F.struct(F.col(_AT[1]).alias("from"), F.col("_text").alias("text")).alias("_piece"),
    )
    joined = parts.groupBy(_AT[0], "_to", "_record").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    text = F.array_join(F.transform("_pieces", lambda x: x["text"]), RECORD_SEP)
    out = whole.unionAll(joined.select(_AT[0], "_to", "_record", text))
    return out.select(F.col(_AT[0]).alias("file"), F.col(_AT[1]).alias("range"), F.col("_record").alias("record"), F.col("_text").alias("text"))


def read_multiline(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, **options) -> DataFrame:
    """The rows of multi-line CSV files, each file read by byte ranges.

    With ``header`` a file's first record names the columns; it must list those of
    ``schema`` in their order.  ``options`` go to the CSV parser."""
    records = record_texts(spark, path).where(F.col("text") != F.lit(""))
    parse = {"quote": '"', "escape": '"', "mode": "FAILFAST", **{k: str(v) for k, v in options.items()}}
    if header:
        first = (F.col("range") == 0) & (F.col("record") == 1)
        names = F.from_csv("text", ", ".join(f"_{k} string" for k in range(len(schema))), parse)
        same = F.array(*[names[f"_{k}"] for k in range(len(schema))]) == F.array(*[F.lit(n) for n in schema.names])
        wrong = F.raise_error(F.concat(F.lit("header is not that of the schema: "), F.col("text")))
        # The header is checked and then dropped; the check is part of the filter, so it is not skipped.
        records = records.where(F.when(first, F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(F.lit(True)))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("text", ddl, parse).alias("_r")).select("_r.*")

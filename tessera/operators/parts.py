"""Size-bounded output: encoded size, partition count, numbered parts.

The size is exact: UTF-8 bytes of every encoded line plus its newline.  Parts are
cut on the running byte offset of the ordered lines: a line belongs to the part
its first byte falls in, so no part is above ``max_bytes`` plus one line, whatever
the rows' widths.  Exact split: the offset runs over all rows.  Range split: it
starts anew in each sampled key range, so only one range is ever looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.encode import csv_header, csv_line, line_bytes
from tessera.operators.paging import int_div, place_in_ranges, rank_rows
from tessera.session import materialize

_RANGE = "_tessera_range"

# Payload target per part, and the row count the estimate samples.
MAX_PART_BYTES = 10 * 1024 * 1024
SAMPLE_ROWS = 10


def part_count(size: Column, max_bytes: int = MAX_PART_BYTES) -> Column:
    """1 part up to ``max_bytes``, else ``floor(size / max_bytes) + 1``."""
    size = size.cast("long")
    whole = (size - F.pmod(size, F.lit(max_bytes))) / F.lit(max_bytes)  # exact: no remainder left
    return F.when(size <= F.lit(max_bytes), F.lit(1)).otherwise(whole + F.lit(1)).cast("long")


def encoded_size(df: DataFrame, columns: list[str] | None = None, timestamp_style: str = "spark") -> DataFrame:
    """``(rows, bytes)`` of the CSV encoding of ``df``: one aggregate pass."""
    line = csv_line(df, columns, timestamp_style)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(line_bytes(line)), F.lit(0)).cast("long").alias("bytes"))


def estimated_size(df: DataFrame, seed: int = 7) -> int:
    """Sampled estimate: exact up to ``SAMPLE_ROWS`` rows, else the bytes of a
    seeded sample of ``SAMPLE_ROWS`` rows scaled by ``rows / SAMPLE_ROWS``."""
    rows = df.count()
    line = csv_line(df)
    if rows <= SAMPLE_ROWS:
        return int(df.agg(F.coalesce(F.sum(line_bytes(line)), F.lit(0))).first()[0])
    h = F.xxhash64(line, F.lit(seed))
    sample_bytes = df.select(line.alias("line")).orderBy(h).limit(SAMPLE_ROWS).agg(F.sum(line_bytes("line"))).first()[0]
    return int(sample_bytes) * rows // SAMPLE_ROWS


def size_plan(df: DataFrame, max_bytes: int = MAX_PART_BYTES, columns: list[str] | None = None) -> DataFrame:
    """``(rows, bytes, parts)`` for ``df``."""
    return encoded_size(df, columns).withColumn("parts", part_count(F.col("bytes"), max_bytes))


def size_partitions(df: DataFrame, max_bytes: int = MAX_PART_BYTES, current: int | None = None) -> DataFrame:
    """Repartition to the size-derived part count.  Tell the ``current`` number
    of partitions, where it is known, to shrink without a shuffle."""
    n = int(size_plan(df, max_bytes).first()["parts"])
    return df.coalesce(n) if current is not None and n < current else df.repartition(n)


def share(pos: Column, pieces: Column, rows: Column) -> Column:
    """``floor(pos * pieces / rows)`` exactly, as an integer (non-negative
    inputs).  The product is taken in ``decimal(38,0)`` (a long product can
    pass 2^63, a double loses digits past 2^53), and the remainder is removed
    before dividing, so the division is exact and nothing is rounded."""
    wide = pos.cast(T.DecimalType(38, 0)) * pieces.cast(T.DecimalType(38, 0))
    n = rows.cast(T.DecimalType(38, 0))
    return ((wide - F.pmod(wide, n)) / n).cast("long")


def number_parts(df: DataFrame, order_by: list[str], parts: int | Column, part_col: str = "part_number") -> DataFrame:
    """Part number 1..parts of every row: ``floor(rank * parts / rows) + 1``."""
    ranked = rank_rows(df, order_by, "_tessera_rank", total_col="_tessera_rows")
    p = F.lit(parts) if isinstance(parts, int) else parts
    return ranked.withColumn(
        part_col, share(F.col("_tessera_rank"), p, F.col("_tessera_rows")) + F.lit(1)
    ).drop("_tessera_rank", "_tessera_rows")


def _range_stats(placed: DataFrame, max_bytes: int) -> DataFrame:
    """Per range: bytes before it, parts before it when each range is cut by
    itself, the last line's bytes of the range before, and the widest line of all."""
    per = placed.groupBy(_RANGE).agg(F.sum("bytes").alias("_b"), F.max("bytes").alias("_w"), F.max_by("bytes", "pos").alias("_l"))
    # The last line begins at bytes - last; a range is never empty here.
    per = per.withColumn("_p", int_div(F.col("_b") - F.col("_l"), max_bytes) + F.lit(1))
    in_order = Window.orderBy(_RANGE)  # one row per range
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return materialize(per.select(
        _RANGE,
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b_before"),
        F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p_before"),
        F.lag("_l").over(in_order).alias("_l_before"),
        F.max("_w").over(Window.partitionBy()).alias("_widest"),
    ), "range-stats")


def parted_lines(df: DataFrame, order_by: list[str], max_bytes: int = MAX_PART_BYTES,
                 columns: list[str] | None = None, subparts: int = 1, quote_cr: bool = False,
                 split: str = "exact", with_line: bool = True) -> DataFrame:
    """``(part_number, subpart, range_id, pos, line, bytes, first)``: encoded
    lines with their part (without ``line``, if only sizes are asked for: then the
    texts are neither shuffled nor written, and the parts are the same).  Parts are numbered from 1 without gaps; lines order by
    (range, position); ``first`` marks the first line of a (part, subpart).

    ``subparts`` cuts every part into that many equal byte ranges (a part may
    have no line in some).  All columns but the line follow from a written
    placement, so reading some of them again gives the same answer."""
    if split not in ("exact", "range"):
        raise ValueError("split must be 'exact' or 'range'")
    cols = columns or df.columns
    line = csv_line(df, cols, quote_cr=quote_cr)
    lines = df.select(*[F.col(k) for k in order_by], line.alias("line")).withColumn("bytes", line_bytes("line").cast("long"))
    lines = lines.withColumn("_tie", F.xxhash64("line"))  # rows of one key: an order that needs no text
    placed = place_in_ranges(lines.select(*order_by, "_tie", "bytes", *(["line"] if with_line else [])), [*order_by, "_tie"], None, _RANGE, "pos")
    stats = _range_stats(placed, max_bytes)
    row = stats.select("_widest").first()
    in_range = Window.partitionBy(_RANGE).orderBy("pos")
    running = F.coalesce(F.sum("bytes").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = placed.withColumn("_start", running).withColumn("_prev", F.lag("bytes").over(in_range)).join(stats, _RANGE)
    if split == "exact":
        at = at.withColumn("_start", F.col("_start") + F.col("_b_before")).withColumn("_prev", F.coalesce("_prev", "_l_before"))
        at = at.withColumn("_of", F.lit(0))
    else:
        at = at.withColumn("_of", F.col(_RANGE))

    def piece(start: Column) -> Column:
        cut = int_div(start, max_bytes)
        return F.struct(cut.alias("cut"), (int_div((start - cut * F.lit(max_bytes)) * F.lit(subparts), max_bytes) + F.lit(1)).alias("sub"))

    at = at.withColumn("_piece", piece(F.col("_start")))
    # The line before it, in its own range or at the end of the one before, is in another piece.
    first = F.col("_prev").isNull() | (F.col("_piece") != piece(F.col("_start") - F.col("_prev")))
    number = F.col("_piece.cut") + F.lit(1) + (F.lit(0) if split == "exact" else F.col("_p_before"))
    if row is not None and row["_widest"] > max_bytes:
        # A line longer than a part skips numbers: number the cuts that have lines (one row a part).
        cuts = at.select("_of", F.col("_piece.cut").alias("_cut")).distinct()
        numbers = cuts.select("_of", "_cut", F.row_number().over(Window.orderBy("_of", "_cut")).cast("long").alias("_number"))
        at = at.withColumn("_cut", F.col("_piece.cut")).join(materialize(numbers, "part-numbers"), ["_of", "_cut"])
        number = F.col("_number")
    return at.select(
        number.cast("long").alias("part_number"), F.col("_piece.sub").cast("int").alias("subpart"), F.col(_RANGE).alias("range_id"),
        "pos", *(["line"] if with_line else []), "bytes", first.alias("first"),
    )


def part_manifest(df: DataFrame, order_by: list[str], max_bytes: int = MAX_PART_BYTES,
                  columns: list[str] | None = None) -> DataFrame:
    """Per part: rows and payload bytes (each line plus its newline)."""
    return _manifest_of(parted_lines(df, order_by, max_bytes, columns, with_line=False))


def _manifest_of(lines: DataFrame) -> DataFrame:
    return lines.groupBy("part_number").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").cast("long").alias("bytes"))


def part_payloads(df: DataFrame, order_by: list[str], max_bytes: int = MAX_PART_BYTES,
                  columns: list[str] | None = None, header: bool = False) -> DataFrame:
    """One payload per part: its lines in order joined by newlines, after the
    header line when ``header`` (a batch).  A part has at most ``max_bytes``
    plus one line, which bounds each collected group."""
    cols = columns or df.columns
    lines = parted_lines(df, order_by, max_bytes, cols)
    agg = lines.groupBy("part_number").agg(
        F.count(F.lit(1)).alias("rows"),
        F.array_sort(F.collect_list(F.struct("range_id", "pos", "line"))).alias("_l"),
    )
    body = F.array_join(F.transform(F.col("_l"), lambda x: x["line"]), "\n")
    if header:
        body = F.concat(F.lit(csv_header(cols) + "\n"), body)
    return agg.select("part_number", "rows", body.alias("payload"))


def gathered(lines: DataFrame, part: str, split: str) -> DataFrame:
    """Each part's lines in one task; a part of the range split lies in one
    range, whose lines are in one task already."""
    return lines.repartition(part) if split == "exact" else lines


def landed_bytes(spark, path: str, by: list[str]) -> DataFrame:
    """Bytes per part folder from the file listing (contents are not read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.groupBy(*by).agg(F.sum("length").cast("long").alias("landed"))


def write_parts(df: DataFrame, path: str, order_by: list[str], max_bytes: int = MAX_PART_BYTES,
                columns: list[str] | None = None, split: str = "exact") -> DataFrame:
    """Write the encoded lines as one text folder per part (``part_number=k``)
    and return the acknowledged part manifest (see ``acknowledge``).
    Spark's output commit makes the write all-or-nothing."""
    # Files this library parses back: a \r inside a value is quoted too.
    lines = parted_lines(df, order_by, max_bytes, columns, quote_cr=True, split=split)
    (
        gathered(lines, "part_number", split)
        # Partition column first, so the writer keeps the line order.
        .sortWithinPartitions("part_number", "range_id", "pos")
        .select("part_number", "line")
        .write.mode("overwrite")
        .partitionBy("part_number")
        .text(path)
    )
    return acknowledge(_manifest_of(lines), landed_bytes(df.sparkSession, path, ["part_number"]))


def acknowledge(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """The planned parts with what landed of them: ``ok`` when all bytes of a
    part are in its files."""
    arrived = F.coalesce(F.col("landed"), F.lit(0))
    sizes = landed.select(F.col("part_number").cast("long"), "landed")
    return manifest.join(sizes, "part_number", "left").select(
        "part_number", "rows", "bytes", arrived.alias("landed"), (arrived == F.col("bytes")).alias("ok")
    )


def parts_ok(acknowledged: DataFrame) -> DataFrame:
    """One row: every part landed whole, and no part number is missing."""
    n = F.count(F.lit(1))
    return acknowledged.agg(
        (F.coalesce(F.bool_and("ok"), F.lit(True)) & (n == F.coalesce(F.max("part_number"), F.lit(0)))
         & (n == F.count_distinct("part_number"))).alias("ok")
    )

"""Global row rank without a single-partition window, and what it feeds:
pages of a result, primary-key chunks, numbered parts.

Rank plan (one range shuffle, no global window over the rows):

1. Inside each input partition, sort by (order keys, hash of the other columns)
   and give each row a copy number (``monotonically_increasing_id``).
2. Range-partition on (order keys, that hash, copy number).  The hash splits a
   hot key value and the copy number a group of identical copies across ranges.
   Only these enter the bounds that Spark samples, never whole rows.
3. Sort within each range; the row's position in its range is
   ``monotonically_increasing_id - (partition << 33)``.
4. Write the placed rows once, then count them per range and turn the counts
   into offsets with a window over one row a range.  Positions and counts come
   from the same written rows, so the rank is right whatever Spark reuses or
   recomputes.  The offsets are joined without a hint: a written table has a
   known size, so Spark broadcasts it while it is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.session import materialize

_COPY = "_tessera_copy"
_PART = "_tessera_range"
_POS = "_tessera_pos"
_HASH = "_tessera_hash"


def _hashed(f: T.StructField) -> Column:
    """A column as ``xxhash64`` takes it: maps and variants by their JSON text."""
    return F.to_json(F.struct(F.col(f"`{f.name}`"))) if _holds_map(f.dataType) else F.col(f"`{f.name}`")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def place_in_ranges(df: DataFrame, order_by: list[str | Column], ranges: int | None = None,
                    range_col: str = "range_id", pos_col: str = "pos_in_range") -> DataFrame:
    """Range-partition ``df`` into ordered partitions (steps 1-3 above; by
    default as many as the session's shuffle partitions) and write them:
    ``range_col`` is the partition (0-based, in order) and ``pos_col`` the
    row's 0-based position inside it."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = {c for c in order_by if isinstance(c, str)}
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [_hashed(f) for f in df.schema.fields if f.name not in named]
    keys = [*order, F.col(_HASH)]
    hashed = df.withColumn(_HASH, F.xxhash64(*rest) if rest else F.lit(0).cast("long"))
    numbered = hashed.sortWithinPartitions(*keys).withColumn(_COPY, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(ranges, *keys, F.col(_COPY)).sortWithinPartitions(*keys, F.col(_COPY))
    placed = ranged.withColumn(range_col, F.spark_partition_id()).withColumn(
        pos_col, F.monotonically_increasing_id() - F.shiftleft(F.col(range_col).cast("long"), 33)
    ).drop(_COPY, _HASH)
    return materialize(placed, "ranges")


def range_offsets(placed: DataFrame, range_col: str, measures: dict[str, Column]) -> DataFrame:
    """Per range, for each measure: its sum over all earlier ranges
    (``<name>_before``) and over all rows (``<name>_all``)."""
    sums = placed.groupBy(range_col).agg(*[F.sum(e).alias(k) for k, e in measures.items()])
    # Windows over one row per range.
    before = Window.orderBy(range_col).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    out = sums.select(
        range_col,
        *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in measures],
        *[F.sum(k).over(every).alias(f"{k}_all") for k in measures],
    )
    return materialize(out, "offsets")


def rank_rows(
    df: DataFrame,
    order_by: list[str | Column],
    rank_col: str = "rank",
    total_col: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` plus a 0-based global rank by ``order_by`` (ties broken by a hash
    of the other columns, so equal inputs give equal ranks as a bag);
    ``total_col`` adds the row count."""
    placed = place_in_ranges(df, order_by, ranges, _PART, _POS)
    offsets = range_offsets(placed, _PART, {"_tessera_n": F.lit(1)})
    out = placed.join(offsets, _PART).withColumn(rank_col, (F.col("_tessera_n_before") + F.col(_POS)).cast("long"))
    if total_col:
        out = out.withColumn(total_col, F.col("_tessera_n_all").cast("long"))
    return out.drop(_PART, _POS, "_tessera_n_before", "_tessera_n_all")


def int_div(a: Column, b: int) -> Column:
    """``floor(a / b)`` for non-negative longs below 2^53, exactly: the
    remainder is removed first, so the division has no fraction to round."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def assign_pages(df: DataFrame, order_by: list[str | Column], page_size: int = 1000,
                 page_col: str = "page", ranges: int | None = None) -> DataFrame:
    """Page number (0-based) of every row when the result is fetched
    ``page_size`` rows at a time in ``order_by`` order; all pages together are
    the whole result."""
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    ranked = rank_rows(df, order_by, "_tessera_rank", ranges=ranges)
    return ranked.withColumn(page_col, int_div(F.col("_tessera_rank"), page_size)).drop(
        "_tessera_rank"
    )


def page(df_with_pages: DataFrame, number: int, page_col: str = "page") -> DataFrame:
    """One page of a paged result."""
    return df_with_pages.where(F.col(page_col) == F.lit(number))


def concat_pages(pages: list[DataFrame]) -> DataFrame:
    """Pages read one after another, as one result (bag union)."""
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out


# Documented default and maximum primary-key chunk sizes.
DEFAULT_CHUNK_SIZE = 100_000
MAX_CHUNK_SIZE = 250_000


def pk_chunks(df: DataFrame, key: str | list[str], chunk_size: int = DEFAULT_CHUNK_SIZE,
              chunk_col: str = "chunk_id", ranges: int | None = None) -> DataFrame:
    """Chunk id of every row when a scan is split into ``chunk_size`` rows by key."""
    if not 0 < chunk_size <= MAX_CHUNK_SIZE:
        raise ValueError(f"chunk_size must be in 1..{MAX_CHUNK_SIZE}")
    keys = [key] if isinstance(key, str) else list(key)
    ranked = rank_rows(df, keys, "_tessera_rank", ranges=ranges)
    return ranked.withColumn(chunk_col, int_div(F.col("_tessera_rank"), chunk_size)).drop(
        "_tessera_rank"
    )


def chunk_bounds(chunked: DataFrame, key: str, chunk_col: str = "chunk_id") -> DataFrame:
    """Per chunk: first key, last key, rows (what a key-range query per chunk uses)."""
    return chunked.groupBy(chunk_col).agg(
        F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count(F.lit(1)).alias("n_rows")
    )


# Fixed value: scans in which neighbouring key ranges are read together.
SPANS = 16


@dataclass(frozen=True)
class KeyRange:
    """The rows with ``low <= key`` (all, where ``low`` is None) and ``key < high`` (all, where it is None)."""

    chunk_id: int
    low: int | float | None
    high: int | float | None
    rows: int

    def of(self, df: DataFrame, key: str) -> DataFrame:
        """This chunk of ``df``: plain comparisons, which reach the file reader and
        skip row groups by their statistics.  Null keys are in the first chunk."""
        k, out = F.col(key), None
        for cond in ([k >= F.lit(self.low)] if self.low is not None else []) + ([k < F.lit(self.high)] if self.high is not None else []):
            out = cond if out is None else out & cond
        if out is None:
            return df
        return df.where(out if self.low is not None else k.isNull() | out)


def _values(values: list, dtype: str) -> Column:
    """A constant array, as one text: a literal a value would be slow to build for many."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{dtype}>")


def _cuts_below(cuts: list, key: Column) -> Column:
    """How many of the ascending ``cuts`` are at or below the key (0 for null): a binary search per row."""
    if not cuts:
        return F.lit(0)
    bounds = _values(cuts, "bigint" if isinstance(cuts[0], int) else "double")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.reduce(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at))


@dataclass(frozen=True)
class Span:
    """Neighbouring key ranges that one scan reads."""

    ranges: list[KeyRange]

    def of(self, df: DataFrame, key: str, chunk_col: str = "chunk_id", rows_col: str = "n_rows") -> DataFrame:
        """The rows of these chunks, read by the whole span's range (``KeyRange.of``),
        each with the number and the rows of the chunk whose range holds its key."""
        first, last = self.ranges[0], self.ranges[-1]
        rows = KeyRange(first.chunk_id, first.low, last.high, 0).of(df, key)
        numbered = rows.withColumn(chunk_col, _cuts_below([r.low for r in self.ranges[1:]], F.col(key)))
        sizes = F.get(_values([r.rows for r in self.ranges], "bigint"), F.col(chunk_col))
        return numbered.withColumn(rows_col, sizes).withColumn(chunk_col, F.col(chunk_col) + F.lit(first.chunk_id))


def spans(ranges: list[KeyRange], most: int = SPANS) -> list[Span]:
    """At most ``most`` runs of neighbouring ranges (one empty run, if there are no
    ranges): up to ``most`` chunks are scanned one by one, more of them in that
    many scans, so that plans and reads do not grow with the number of chunks."""
    ranges = ranges or [KeyRange(0, None, None, 0)]
    n = min(most, len(ranges))
    ends = [len(ranges) * i // n for i in range(n + 1)]
    return [Span(ranges[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def key_ranges(df: DataFrame, key: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> list[KeyRange]:
    """Ranges of a numeric key that cut ``df`` into chunks of at most ``chunk_size``
    rows each, by exact counts and without moving rows.

    The rows are counted per key value (a hot value is combined map-side), and the
    values with their counts are placed in ranges of the key; running counts cut
    each range at multiples of ``chunk_size``, and a value across such a cut is a
    chunk of its own.  Neighbours that fit one chunk become one.  A single key value
    with more rows than ``chunk_size`` is a chunk of its own.  Each chunk can then be
    read alone by pushed-down comparisons (``KeyRange.of``), or many in a few scans
    (``spans``).  The jobs are as many for any table; the driver holds one row per
    chunk."""
    if not 0 < chunk_size <= MAX_CHUNK_SIZE:
        raise ValueError(f"chunk_size must be in 1..{MAX_CHUNK_SIZE}")
    whole = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    counted = df.groupBy(F.col(key).cast("long" if whole else "double").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    placed = place_in_ranges(counted, ["k"])
    before = Window.partitionBy("range_id").orderBy("pos_in_range").rowsBetween(Window.unboundedPreceding, -1)
    started = placed.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cut = started.withColumn("at", int_div(F.col("start"), chunk_size)).withColumn("across", int_div(F.col("start") + F.col("n") - 1, chunk_size) > F.col("at"))
    found = cut.groupBy("range_id", "at", "across").agg(F.min("k").alias("low"), F.sum("n").alias("rows"))
    pieces: list[list] = []  # [first key, rows]
    for r in sorted(found.collect(), key=lambda r: (r["range_id"], r["at"], r["across"])):
        if pieces and pieces[-1][1] + r["rows"] <= chunk_size:
            pieces[-1][1] += r["rows"]
        else:
            pieces.append([r["low"], r["rows"]])
    lows = [None, *[low for low, _ in pieces[1:]]]
    return [KeyRange(i, low, high, rows) for i, (low, high, (_, rows)) in enumerate(zip(lows, [*lows[1:], None], pieces, strict=False))]


def exact_sample(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """A repeatable sample of exactly ``min(n, rows)`` rows without replacement:
    the ``n`` smallest md5 digests of the seed and the key's text (a bounded
    top-n)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return df.orderBy(F.md5(text), *key).limit(n)


def sample_with_replacement(df: DataFrame, n: int, key: list[str], seed: int = 42, draw_col: str = "draw") -> DataFrame:
    """Exactly ``n`` draws with replacement (none from an empty ``df``): the drawn
    rows, each with its draw number from 0.

    Draw ``i`` takes the row at position ``h(seed, i) mod rows`` of the rows ordered
    by ``key``, with ``h`` the first 60 bits of an md5 digest; so the sample repeats
    and does not depend on partitioning.  The rows are ranked by range (no global
    sort), and the ``n`` draws are joined by rank: a small sample is broadcast by
    AQE, a large one is shuffled."""
    if n < 0:
        raise ValueError("n must not be negative")
    ranked = rank_rows(df, list(key), "_tessera_rank", total_col="_tessera_rows")
    rows = ranked.agg(F.max("_tessera_rows")).first()[0]  # one number, from the written placement
    if not rows:
        return df.where(F.lit(False)).withColumn(draw_col, F.lit(0).cast("long"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(draw_col).cast("string")))
    at = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(rows)
    draws = df.sparkSession.range(n).withColumnRenamed("id", draw_col).withColumn("_tessera_rank", at)
    return ranked.join(draws, "_tessera_rank").select(*df.columns, draw_col)

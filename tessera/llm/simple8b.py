"""Token-id output: Simple-8b words with selectors, escapes and block offsets.

Each 64-bit word has a 4-bit selector in its top bits.  Selectors 1 to 14 pack
``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits each, the first id in the lowest
bits.  Selector 15 is the escape: the id is the whole next word (for values of
more than 60 bits).  Ids are cut into blocks of 256; a block's first word is in
the offsets, so all blocks are packed, and all words are unpacked, in step.

File format: a Parquet table of segments (the container gives atomic commits on
any store).  Columns: part, segment, ids_before (ids of the part before this
segment), doc_ids, doc_tokens, words (little-endian 64-bit), block_words (first
word of each block).  Parts and segments are in ascending document order.

Defined cases: null and empty texts have the end id only.  Rows with one doc_id
stay next to each other (ordered by text); null ids come first.  An empty table
gives an empty file set.  A text is never cut: a segment has one document at
least.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import c
from tessera.llm.tokens import encode_texts, splits_at_space
from tessera.llm.words import blocks, ranges

BLOCK = 256
#: Ids per word by selector (0 is not used, 15 is the escape).
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
ESCAPE = 15
LOW60 = np.uint64((1 << 60) - 1)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value (1 for zero), as bytes."""
    if values.dtype.itemsize <= 4:  # floats hold these exactly
        return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)
    high = (values >> np.uint64(32)).astype(np.uint32)
    low = values.astype(np.uint32)
    return np.where(high > 0, 32 + _bits(high), _bits(low)).astype(np.uint8)


def _selectors(bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position the selector of a word that starts there: as many ids as fit.

    ``left``: ids up to the end of the position's block.
    """
    best = np.full(len(bits), ESCAPE, np.uint8)
    widest, have = bits.copy(), 1
    for s in range(14, 0, -1):
        n = int(COUNTS[s])
        while have < n:  # widest[i] is the most bits of the `have` ids from i on
            if have * 2 <= n:
                np.maximum(widest[:-have], widest[have:], out=widest[:-have])
                have *= 2
            else:
                step = n - have
                np.maximum(widest[:-step], widest[step:], out=widest[:-step])
                have = n
        if len(bits) < n:
            break
        best[(widest <= 60 // n) & (left >= n)] = s
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``values`` and the first word of each block of 256."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    at = np.arange(n)
    select = _selectors(_bits(values), np.minimum(n, (at // BLOCK + 1) * BLOCK) - at)
    starts = np.arange(0, n, BLOCK)
    ends = np.minimum(starts + BLOCK, n)
    # All blocks walk from word to word together.
    head = np.zeros(n, bool)
    now, until = starts, ends
    while len(now):
        head[now] = True
        now = now + COUNTS[select[now]]
        go = now < until
        now, until = now[go], until[go]
    first = np.flatnonzero(head)
    kind = select[first].astype(np.int64)
    size = 1 + (kind == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    wide = values.astype(np.uint64)
    for s in np.unique(kind).tolist():
        which = np.flatnonzero(kind == s)
        if s == ESCAPE:
            words[place[which] + 1] = wide[first[which]]
            word = np.zeros(len(which), np.uint64)
        else:
            k, word = int(COUNTS[s]), np.zeros(len(which), np.uint64)
            for j in range(k):
                word |= wide[first[which] + j] << np.uint64(j * (60 // k))
        words[place[which]] = word | np.uint64(s << 60)
    block_words = place[np.searchsorted(first, starts)].astype(np.int32)
    return words, block_words


def unpack(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of ``pack``'s words, as 64-bit numbers."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    kind = (words >> np.uint64(60)).astype(np.int64)
    # The word after an escape is data, whatever its top bits say; escapes are rare.
    data = np.zeros(len(words), bool)
    for i in np.flatnonzero(kind == ESCAPE).tolist():
        if not data[i]:
            data[i + 1] = True
    heads = np.flatnonzero(~data)
    kind = kind[heads]
    counts = COUNTS[kind]
    place = np.cumsum(counts) - counts
    # A block's first word holds its first value.
    if not np.array_equal(place[np.searchsorted(heads, block_words)], np.arange(0, n, BLOCK)):
        raise ValueError("block offsets do not match the words")
    for s in np.unique(kind).tolist():
        which = np.flatnonzero(kind == s)
        if s == ESCAPE:
            out[place[which]] = words[heads[which] + 1]
            continue
        k = int(COUNTS[s])
        width, body = 60 // k, words[heads[which]] & LOW60
        low = np.uint64((1 << width) - 1)
        for j in range(k):
            out[place[which] + j] = (body >> np.uint64(j * width)) & low
    return out


def unpack_range(words: np.ndarray, block_words: np.ndarray, n: int, start: int, length: int) -> np.ndarray:
    """``length`` values from ``start`` on; reads only the blocks they lie in."""
    a, b = start // BLOCK, -(-(start + length) // BLOCK)
    to = int(block_words[b]) if b < len(block_words) else len(words)
    if length <= 0:
        return np.zeros(0, np.uint64)
    part = unpack(words[int(block_words[a]) : to], block_words[a:b] - block_words[a], min(n, b * BLOCK) - a * BLOCK)
    return part[start - a * BLOCK : start - a * BLOCK + length]


FILE_SCHEMA = "part int, segment int, ids_before long, doc_ids array<long>, doc_tokens array<long>, words binary, block_words binary"
_ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("ids_before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("words", pa.binary()), ("block_words", pa.binary()),
])


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts in ascending id order; one file for each range of ids."""
    if not splits_at_space(tokenizer):
        raise ValueError(f"{tokenizer}: this tokenizer does not drop white space")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for segment, batch in enumerate(blocks(batches, "text", 2 << 20)):
            ids, rows = encode_texts(batch.column("text"), tokenizer, end_id)
            words, block_words = pack(ids)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "segment": segment, "ids_before": before, "doc_ids": batch.column("id").to_pylist(),
                "doc_tokens": np.diff(rows).tolist(), "words": words.astype("<u8").tobytes(), "block_words": block_words.astype("<i4").tobytes(),
            }], _ARROW)
            before += len(ids)

    rows = docs.select(c(id_col).cast("long").alias("id"), c(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the crc32 of its ids."""
    segments = spark.read.schema(FILE_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in ("part", "ids_before", "doc_ids", "doc_tokens", "words", "block_words")}
                n = np.array(row["doc_tokens"].as_py(), np.int64)
                ids = unpack(np.frombuffer(row["words"].as_buffer(), "<u8"), np.frombuffer(row["block_words"].as_buffer(), "<i4"), int(n.sum()))
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(n)
                sums = [zlib.crc32(raw[4 * (e - m) : 4 * e]) for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"].as_py()] * len(n), pa.int32()), row["doc_ids"].values, pa.array(row["ids_before"].as_py() + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.int64())],
                    names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    docs = segments.mapInArrow(run, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    # One row a part (a task of the writing job), so this small side has a bound that no table moves.
    totals = segments.select("part", (F.col("ids_before") + F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto")).groupBy("part").agg(F.max("upto").alias("total"))
    offsets, before = {}, 0
    for part, total in sorted(totals.collect()):
        offsets[part] = before
        before += total
    if not offsets:
        return docs.select("doc_id", F.col("start_in_part").alias("start"), "n_tokens", "ids_crc32")
    starts = spark.createDataFrame(sorted(offsets.items()), "part int, part_start long")
    return docs.join(F.broadcast(starts), "part").select("doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")

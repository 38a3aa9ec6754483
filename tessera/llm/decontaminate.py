"""Benchmark decontamination with a distributed positional inverted index.

Method: the training texts' token postings are stored as an index of blocks
(about 4 MB of text each; a block is one row of the stored table and holds, for
each of its words, the sorted positions).  Benchmark windows are answered block
by block: the window's rarest word in the block gives the candidate starts, and
the offset-adjusted postings of its other words, next rarest first, thin them
out.  All windows are intersected together with numpy, so a window costs no
Python step.  Matches come back exact (phrases) or within ``slop`` words of
their places (proximity).

Scale: the index is partitioned by document, so no posting is shuffled and a
word that all texts hold is no hot key.  The query set travels in blocks of
``QUERY_BYTES``, each a job over the index whose matches are written before the
next block is taken, so the driver and a task hold one block.  Only the matches of the documents with hits are
grouped.

Defined cases: null and empty texts have no words and no hits.  Null ids are
kept.  Rows with the same doc_id are separate documents: a row is known by
(block, place in block).  Repeated benchmark rows with one item_id are one item,
null item ids are an item of their own named "" in the digest.  An item without
words has no window.  Empty tables give empty results, an empty benchmark no
hits.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import c, fresh, scratch_path, written
from tessera.llm.words import ALNUM, blocks, ranges, split_words

WINDOW = 13
#: Bytes of benchmark text answered in one job (its windows are about ten times as large).
QUERY_BYTES = 1 << 20

INDEX_SCHEMA = "block string, doc_ids array<long>, doc_words array<long>, terms array<string>, term_starts binary, postings binary"
_COLUMNS = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the postings of all words of all texts; one row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(blocks(batches, "text")):
            words = split_words(batch.column("text"), ALNUM, lower=True)
            codes, terms = words.codes()
            order = np.argsort(codes, kind="stable")
            starts = np.searchsorted(codes[order], np.arange(len(terms) + 1))
            one = pa.array([0, len(terms)], pa.int32())
            rows = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{k}"]), pa.ListArray.from_arrays(rows, batch.column("id")), pa.ListArray.from_arrays(rows, pa.array(np.diff(words.rows), pa.int64())),
                pa.ListArray.from_arrays(one, terms.cast(pa.string())), pa.array([starts.astype("<i4").tobytes()], pa.binary()), pa.array([order.astype("<i4").tobytes()], pa.binary()),
            ], names=_COLUMNS)

    return written(docs.select(c(id_col).cast("long").alias("id"), c(text).alias("text")).mapInArrow(run, INDEX_SCHEMA), "postings")


class Queries:
    """Windows of a set of items: 13 consecutive words, or a shorter item's words."""

    def __init__(self, items: list[str], texts: list[str | None], window: int = WINDOW):
        words = split_words(pa.array(texts, pa.large_string()), ALNUM, lower=True)
        codes, vocabulary = words.codes()
        self.items, self.vocabulary = items, vocabulary.to_pylist()
        n = np.diff(words.rows)
        length = np.minimum(n, window)
        count = np.where(n > 0, n - length + 1, 0)
        self.item = np.repeat(np.arange(len(n)), count)
        self.length = np.repeat(length, count)
        first = ranges(words.rows[:-1], count)
        at = first[:, None] + np.arange(window)[None, :]
        inside = np.arange(window)[None, :] < self.length[:, None]
        self.terms = np.where(inside, codes[np.where(inside, at, 0)] if len(codes) else 0, -1).astype(np.int32)


def query_blocks(benchmark: DataFrame, id_col: str, text: str, window: int = WINDOW) -> Iterator[Queries]:
    """The benchmark in blocks of bounded size, read row by row."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(c(id_col).cast("string").alias("i"), c(text).alias("t")).toLocalIterator():
        ids.append(row["i"] or "")
        texts.append(row["t"])
        size += len(row["t"] or "") + 16
        if size >= QUERY_BYTES:
            yield Queries(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield Queries(ids, texts, window)


def intersect(q: Queries, local: np.ndarray, starts: np.ndarray, postings: np.ndarray, doc_ends: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all matches in a block.

    ``local``: the block's number of each word of the query vocabulary, or -1.
    With ``slop`` the start is the rarest word's place less its offset, and each
    other word lies within ``slop`` words of its place, in the same document.
    """
    none = np.zeros(0, np.int64)
    held = q.terms >= 0
    term = np.where(held, local[q.terms], -1)  # 64-bit, as the keys below
    possible = np.flatnonzero(((term >= 0) | ~held).all(axis=1) & (q.length > 0))
    if not len(possible):
        return none, none
    term, held = term[possible], held[possible]
    count = np.where(held, starts[np.where(held, term, 0) + 1] - starts[np.where(held, term, 0)], np.iinfo(np.int32).max)
    order = np.argsort(count, axis=1, kind="stable")
    # One sorted key for all postings: word, then position.
    width = np.int64(len(postings) + 1 + 2 * slop)
    keys = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * width + postings
    rows = np.arange(len(possible))
    rare = order[:, 0]
    lead = term[rows, rare]
    n = starts[lead + 1] - starts[lead]
    which = np.repeat(rows, n)
    start = postings[ranges(starts[lead], n)].astype(np.int64) - np.repeat(rare, n)
    length = q.length[possible]
    pivot = start + np.repeat(rare, n)
    doc = np.searchsorted(doc_ends, pivot, side="right")
    low = np.concatenate([[0], doc_ends])[doc]
    high = doc_ends[doc]
    if slop == 0:  # the whole window lies in one document
        ok = (start >= low) & (start + length[which] <= high)
        which, start, low, high = which[ok], start[ok], low[ok], high[ok]
    for k in range(1, q.terms.shape[1]):
        if not len(which):
            return none, none
        offset = order[which, k]
        asked = held[which, offset]
        want = start + offset
        near_low = np.maximum(want - slop, low)
        near_high = np.minimum(want + slop, high - 1)
        base = term[which, offset] * width
        at = np.searchsorted(keys, base + near_low)
        found = (at < len(keys)) & (near_low <= near_high)
        found &= keys[np.minimum(at, len(keys) - 1)] <= base + near_high
        ok = found | ~asked
        which, start, low, high = which[ok], start[ok], low[ok], high[ok]
    return possible[which], start


MATCH_SCHEMA = "block string, place int, item string, starts array<long>, lengths array<int>"


def find(index: DataFrame, q: Queries, slop: int = 0) -> DataFrame:
    """Per document row and item: the word positions and lengths of its matching windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(q.vocabulary, pa.string())
        for batch in batches:
            for k in range(batch.num_rows):
                terms = batch.column("terms")[k].values
                local = np.asarray(pc.index_in(wanted, terms).fill_null(-1)).astype(np.int64) if len(terms) else np.full(len(wanted), -1)
                starts = np.frombuffer(batch.column("term_starts")[k].as_buffer(), "<i4").astype(np.int64)
                postings = np.frombuffer(batch.column("postings")[k].as_buffer(), "<i4")
                ends = np.cumsum(np.array(batch.column("doc_words")[k].as_py(), np.int64))
                window, start = intersect(q, local, starts, postings, ends, slop)
                if not len(window):
                    continue
                doc = np.searchsorted(ends, start if slop == 0 else np.clip(start, 0, ends[-1] - 1), side="right")
                start = start - np.concatenate([[0], ends])[doc]
                order = np.lexsort((start, q.item[window], doc))
                window, start, doc = window[order], start[order], doc[order]
                item = q.item[window]
                cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]))
                offsets = pa.array(np.append(cut, len(doc)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[k].as_py()] * len(cut)), pa.array(doc[cut], pa.int32()), pa.array([q.items[i] for i in item[cut]], pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(start, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(q.length[window], pa.int32())),
                ], names=["block", "place", "item", "starts", "lengths"])

    return index.mapInArrow(run, MATCH_SCHEMA)


def search(index: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Exact phrase matches (``slop`` 0) or proximity matches of all benchmark windows.

    Each block of queries is one job over the index; with more than one block its
    matches are written before the next block is taken, so the driver and a task
    hold one block of ``QUERY_BYTES`` at any size of the benchmark."""
    spark, paths, held = index.sparkSession, [], None

    def put(q: Queries) -> None:
        paths.append(scratch_path(spark, "matches"))
        find(index, q, slop).write.parquet(paths[-1])

    for q in query_blocks(benchmark, id_col, text, window):
        if held is not None:
            put(held)
        held = q
    if held is None:
        return spark.createDataFrame([], MATCH_SCHEMA)
    if not paths:
        return find(index, held, slop)
    put(held)
    return spark.read.schema(MATCH_SCHEMA).parquet(*paths)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", share: int = 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted as strings), contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated
    with a hit and at least one hit word in ``share``.
    """
    index = build_index(docs, id_col, text)
    matches = written(search(index, benchmark, item_col, item_text), "matches")
    key = ["block", "place"]
    spans = matches.select(*key, F.explode(F.arrays_zip("starts", "lengths")).alias("s")).select(*key, F.col("s.starts").alias("a"), (F.col("s.starts") + F.col("s.lengths")).alias("b")).distinct()
    reach = Window.partitionBy(*key).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max("b").over(reach), F.lit(0))
    hits = spans.withColumn("new", F.greatest(F.col("b") - F.greatest(F.col("a"), seen), F.lit(0))).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    items = matches.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("place", "d")).select("block", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(hits.join(items, key), key, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones.

    Of rows that share a doc_id, all go when one is contaminated (null is one id).
    """
    bad = contamination(docs, benchmark, id_col, text, item_col, item_text).where("contaminated")
    bad_id = fresh(docs, "bad_id")
    bad = bad.select(F.col("doc_id").alias(bad_id)).distinct()
    return docs.join(bad, c(id_col).cast("long").eqNullSafe(c(bad_id)), "left_anti")

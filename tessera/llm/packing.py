"""Packing: windows of neighbours found by a sharded BM25 inverted index.

Method: documents are tokenised once; their tokens, with document frequencies, count and
mean length of the whole corpus, give each a content key: the closest of ``DIRECTIONS``
fixed random directions in order of the BM25 weights' projection, and a digest, so that
copies are neighbours.  Nothing is estimated from a sample.  Documents in key order are cut
into shards of about ``SHARD_TOKENS`` tokens, so alike documents meet in one shard
wherever they stood in the input.  Each shard gets an inverted index of BM25 weights
(document frequencies, count and mean length are those of the whole corpus).  The
document at a window's start is the window's query; with all its terms it asks the
index for its best unused neighbours, which fill the window, best first.  A document
that does not fit is cut, and what is left of it is the query of the next window.  A
query without further neighbours gives way to the last document, then to the next
unused one.  So every window is full, and only a shard's last tokens are short of one:
they become sequences whose lengths are powers of two, which need no padding.

What the index may miss: a neighbour whose nearest directions differ from the query's is in
another shard.  The README has the measured share of corpus-wide best neighbours that
a shard holds.  ``shard_tokens=None`` puts all documents into one shard, which is the
exact search, for tables that fit a task.

Scale: linear in the corpus.  Texts are read and tokenised once; tokens are written
twice (without and with their keys) and shuffled once, by range of (key, row), so a group
of copies of any size spreads over shards.  A task holds one shard; the driver holds one
number per token id.  No document is known to the driver.

Defined cases: a null or empty text is its end id.  Each row is packed, also with
a null or repeated doc_id.  A document longer than a window fills whole windows
and seeds with the rest; one longer than a shard is a shard.  The end id is no term.
Ties in BM25 go to the earlier document of the shard.  An empty table gives an empty
result.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import c, written
from tessera.llm.tokens import encode_texts, forget, give_back, splits_at_space, vocabulary_size
from tessera.llm.words import blocks, ranges

WINDOW = 4096
SHARD_TOKENS = 1 << 20
#: Random directions, and the closest of them in a key.
DIRECTIONS, KEY = 16, 8
#: Postings that are projected at once, and tokens that are counted at once.
POSTINGS, TOKENS = 1 << 13, 1 << 20
#: Entries of a shard's whole (term, document) table up to which it is kept as one.
TABLE = 1 << 23
#: Rows of an Arrow batch; whole documents lie in it.
BATCH_ROWS = 1000
K1, B = 1.2, 0.75

TOKENS_SCHEMA = "row long, doc_id long, n long, ids binary, terms array<int>, doc_counts array<int>"
_TOKENS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("terms", pa.list_(pa.int32())), ("doc_counts", pa.list_(pa.int32()))])
STORE_SCHEMA = "key binary, row long, doc_id long, n long, ids binary"
_STORE = [x.split()[0] for x in STORE_SCHEMA.split(", ")]
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, shard long"
_PIECE = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_ROWS`` rows for the jobs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def term_counts(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids per document and how often each occurs: (first entry of each document, ids, counts)."""
    rows = np.concatenate([[0], np.cumsum(n)])
    ordered = ids.astype(np.uint16 if not len(ids) or ids.max() < 1 << 16 else np.uint32)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        ordered[a:b].sort(kind="stable")
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[rows[:-1][n > 0]] = True
    at = np.flatnonzero(new)
    return np.searchsorted(at, rows[:-1]), ordered[at], np.diff(np.append(at, len(ordered)))


def weights(counts: np.ndarray, n: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weight of terms by their counts in documents of ``n`` tokens, before idf."""
    return counts * (K1 + 1) / (counts + K1 * (1 - B + B * n / mean))


def inverse(df: np.ndarray, total: int, end_id: int) -> np.ndarray:
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    idf[end_id] = 0  # it ends all documents and is no term
    return idf


class Bm25:
    """Inverted index of one shard: per token id its documents and their BM25 weights."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, idf: np.ndarray, mean: float):
        self.docs = len(n)
        self.first, self.terms, counts = term_counts(ids, n)
        per_doc = np.diff(np.append(self.first, len(self.terms)))
        doc = np.repeat(np.arange(len(n)), per_doc)
        by_term = np.argsort(self.terms, kind="stable")
        self.doc = doc[by_term]
        self.starts = np.searchsorted(self.terms[by_term], np.arange(len(idf) + 1))
        self.weight = (weights(counts, n[doc], mean) * idf[self.terms])[by_term].astype(np.float32)
        held = np.diff(self.starts) > 0
        self.place, self.table = np.cumsum(held) - 1, None  # rows of the terms that the shard holds
        if held.sum() * len(n) <= TABLE:
            self.table = np.zeros((int(held.sum()), len(n)), np.float32)
            self.table[self.place[self.terms[by_term]], self.doc] = self.weight

    def terms_of(self, d: int) -> np.ndarray:
        return self.terms[self.first[d] : self.first[d + 1] if d + 1 < self.docs else None].astype(np.int64)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Scores of the documents for a query of distinct terms."""
        if self.table is not None:
            terms = terms[self.starts[terms + 1] > self.starts[terms]]
            return self.table[self.place[terms]].sum(axis=0)
        at = ranges(self.starts[terms], self.starts[terms + 1] - self.starts[terms])
        return np.bincount(self.doc[at], self.weight[at], self.docs)


def nearest(score: np.ndarray, n: np.ndarray, room: int) -> np.ndarray:
    """The best documents, best first, until they fill the room; those of no score are left out."""
    near = np.flatnonzero(score > 0)
    if len(near) > 64:
        least = np.partition(score[near], len(near) - 64)[len(near) - 64]
        best = near[score[near] >= least]
        if n[best].sum() >= room:
            near = best
    near = near[np.argsort(-score[near], kind="stable")]
    return near[np.cumsum(n[near]) - n[near] < room]


def deal(n: np.ndarray, index: Bm25, window: int) -> np.ndarray:
    """The order of a shard's documents in which windows are cut from their tokens."""
    used, order, at, following = np.zeros(len(n), bool), [], 0, 0

    def add(d: int) -> bool:
        nonlocal at
        before = at // window
        used[d], at = True, at + int(n[d])
        order.append(d)
        return at // window != before

    while len(order) < len(n):
        while used[following]:
            following += 1
        add(query := following)
        while at % window and len(order) < len(n):
            score = index.scores(index.terms_of(query))
            score[used] = 0
            for d in nearest(score, n, window - at % window).tolist():
                if add(d):
                    query = d
                    break
            else:  # the query has no more neighbours
                if query == order[-1]:
                    break
                query = order[-1]
    return np.array(order, np.int64)


def sequences(total: int, window: int) -> np.ndarray:
    """First token of each sequence: whole windows, then falling powers of two."""
    whole, ends = total - total % window, []
    at = whole
    while at < total:
        ends.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return np.concatenate([np.arange(0, whole, window), np.array(ends, np.int64)]).astype(np.int64)


def cut(order: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """The pieces of documents in this order: (document, start, length, sequence, offset, sequence length)."""
    length = n[order]
    at, total = np.cumsum(length) - length, int(length.sum())
    begin = sequences(total, window)
    piece = np.unique(np.concatenate([at, begin]))
    d, s = np.searchsorted(at, piece, side="right") - 1, np.searchsorted(begin, piece, side="right") - 1
    return order[d], piece - at[d], np.diff(np.append(piece, total)), s, piece - begin[s], np.diff(np.append(begin, total))[s]


def fill_windows(ids: np.ndarray, n: np.ndarray, index: Bm25, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces; each id lies in exactly one."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    for d, start, length, s, *_ in zip(*(x.tolist() for x in cut(deal(n, index, window), n, window)), strict=True):
        out.setdefault(s, []).append((d, start, length))
    return list(out.values())


class Corpus(NamedTuple):
    """Counts over all documents."""

    docs: int
    tokens: int
    idf: np.ndarray
    mean: float


def directions(idf: np.ndarray) -> np.ndarray:
    """Per token id its idf with a fixed random sign in each direction; a column per direction."""
    signs = np.random.default_rng(42).integers(0, 2, (len(idf), DIRECTIONS)).astype(np.float32) * 2 - 1
    return signs * idf[:, None].astype(np.float32)


def _keys(first: np.ndarray, terms: np.ndarray, weight: np.ndarray, towards: np.ndarray) -> np.ndarray:
    """Per document the closest directions, best first, as bytes."""
    out = np.zeros((len(first), KEY), np.uint8)
    ends, k = np.append(first[1:], len(terms)), 0
    while k < len(first):
        to = max(k + 1, int(np.searchsorted(ends, first[k] + POSTINGS, side="right")))
        part = slice(first[k], ends[to - 1])
        score = np.add.reduceat(towards[terms[part]] * weight[part, None], first[k:to] - first[k], axis=0)
        out[k:to] = np.argsort(-score, axis=1, kind="stable")[:, :KEY]
        k = to
    return out


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str) -> DataFrame:
    """The tokens of all texts, a row a document; and a row a task of documents per token id."""
    if not splits_at_space(tokenizer):
        raise ValueError(f"{tokenizer}: this tokenizer does not drop white space")
    size, kind = _ids(tokenizer, end_id)
    rows = docs.select(c(id_col).cast("long").alias("id"), c(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, holders = TaskContext.get().partitionId() << 33, np.zeros(size, np.int32)
        for batch in blocks(batches, "text", 4 << 20):
            ids, at = encode_texts(batch.column("text"), tokenizer, end_id)
            n = np.diff(at)
            holders += np.bincount(term_counts(ids, n)[1], minlength=size).astype(np.int32)
            raw, width = ids.astype(kind), np.dtype(kind).itemsize
            body = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer((at * width).astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
            none = pa.nulls(len(n), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(n))), batch.column("id"), pa.array(n), body, none, none], schema=_TOKENS)
            row += len(n)
        seen = np.flatnonzero(holders)
        if len(seen):
            yield pa.RecordBatch.from_pylist([dict.fromkeys(_TOKENS.names) | {"terms": seen, "doc_counts": holders[seen]}], _TOKENS)
        give_back()

    with small_batches(docs.sparkSession):
        return written(rows.mapInArrow(run, TOKENS_SCHEMA), "tokens")


def counted(tokens: DataFrame, size: int, end_id: int) -> Corpus:
    """Document frequencies, count and mean length of all documents."""
    sums = tokens.agg(F.count("row").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    df = np.zeros(size)
    holders = tokens.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "doc_counts")).alias("x"))
    for term, n in holders.groupBy("x.terms").agg(F.sum("x.doc_counts")).collect():  # one row a token id: the vocabulary's size at most
        df[term] = n
    return Corpus(sums["docs"], sums["tokens"], inverse(df, sums["docs"], end_id), sums["tokens"] / max(sums["docs"], 1) or 1.0)


def keyed(tokens: DataFrame, corpus: Corpus, kind: str) -> DataFrame:
    """The documents' tokens with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        towards, width = directions(corpus.idf), np.dtype(kind).itemsize
        for batch in batches:
            all_n, at = batch.column("n").to_numpy(), 0
            ends = np.cumsum(all_n)
            while at < len(all_n):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] - all_n[at] + TOKENS, side="right")))
                part, n, at = batch.slice(at, to - at), all_n[at:to], to
                body = part.column("ids").cast(pa.large_binary())
                offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
                raw = memoryview(body.buffers()[2])[offsets[0] : offsets[-1]]
                first, terms, counts = term_counts(np.frombuffer(raw, kind), n)
                weight = weights(counts, np.repeat(n, np.diff(np.append(first, len(terms)))), corpus.mean)
                keys = _keys(first, terms, weight.astype(np.float32), towards)
                cuts = np.concatenate([[0], np.cumsum(n) * width]).tolist()
                digest = np.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], ">u4").view(np.uint8).reshape(-1, 4)
                key = pa.Array.from_buffers(pa.binary(KEY + 4), len(n), [None, pa.py_buffer(np.hstack([keys, digest]))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([key, *[part.column(x) for x in _STORE[1:]]], names=_STORE)

    with small_batches(tokens.sparkSession):
        return written(tokens.where("row IS NOT NULL").select(*_STORE[1:]).mapInArrow(run, STORE_SCHEMA), "token-docs")


def _ids(tokenizer: str, end_id: int) -> tuple[int, str]:
    """Number of token ids, and the type they are stored in."""
    size = max(vocabulary_size(tokenizer), end_id + 1)
    return size, "<u2" if size <= 1 << 16 else "<u4"


def store(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str) -> DataFrame:
    """The tokens of all texts with their keys, a row a document."""
    size, kind = _ids(tokenizer, end_id)
    tokens = tokenised(docs, tokenizer, end_id, id_col, text)
    return keyed(tokens, counted(tokens, size, end_id), kind)


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, shard_tokens: int | None = SHARD_TOKENS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, shard."""
    size, kind = _ids(tokenizer, end_id)
    tokens = tokenised(docs, tokenizer, end_id, id_col, text)
    corpus = counted(tokens, size, end_id)
    stored = keyed(tokens, corpus, kind)
    spark, idf, mean = stored.sparkSession, corpus.idf, corpus.mean
    shards = 1 if shard_tokens is None else max(1, corpus.tokens // shard_tokens)
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // 8)))
    placed = stored.select("key", "row", "doc_id", "ids").repartitionByRange(tasks, "key", "row").sortWithinPartitions("key", "row")

    def filled(shard: int, names: list, parts: list[bytes]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(parts), kind)
        n = np.array([len(x) for x in parts], np.int64) // ids.itemsize
        d, start, length, s, offset, whole = cut(deal(n, Bm25(ids, n, idf, mean), window), n, window)
        raw = memoryview(ids.astype("<u4").tobytes())
        a = 4 * ((np.cumsum(n) - n)[d] + start)
        crc = [zlib.crc32(raw[i:j]) for i, j in zip(a.tolist(), (a + 4 * length).tolist(), strict=True)]
        cols = [pa.array(names, pa.int64()).take(pa.array(d)), start, length, crc, n[d], shard << 20 | s, offset, whole, np.full(len(d), shard)]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in cols], names=_PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shard = TaskContext.get().partitionId() << 20
        names: list = []
        parts: list[bytes] = []
        held = 0
        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if shard_tokens is not None and parts and held + len(ids) > shard_tokens * np.dtype(kind).itemsize:
                    yield filled(shard, names, parts)
                    shard, names, parts, held = shard + 1, [], [], 0
                names.append(name)
                parts.append(ids)
                held += len(ids)
        if parts:
            yield filled(shard, names, parts)

    with small_batches(spark):
        return written(placed.select("doc_id", "ids").mapInArrow(run, PIECE_SCHEMA), "packed")

"""Prefix trie of conversations by padded turn-id matrices over range shards.

Method: a turn's id is the 128-bit digest of its role and text, a conversation's
path the ids of its turns one after the other.  Paths are placed into range shards
by Spark, in lexicographic order of (path, conv_id).  A shard numbers its ids, pads
them to a matrix of turn numbers, sorts the rows with ``numpy.lexsort`` and
OR-accumulates, along the columns, where a row differs from the one before: where the
accumulated mask first turns true, a row's nodes start.  ``reduceat`` over the rows
that start a node gives the members, children, leaves and saved bytes of all nodes of
one depth.  Long rows are padded ``WIDTH`` columns at a time; only rows that are
still equal to a neighbour get the next columns, and the depths that one row has to
itself need no matrix.

A node whose rows touch the first or the last row of a shard may go on in the next
shard.  Such boundary nodes (one path down each side of a shard) are recombined: the
turns that the last row of a shard shares with the first of the next tell which of
them are one node, and what the two shards counted twice (a start, a leaf) is taken
back.  All measures are sums, so the rest adds up; children of boundary nodes look
their parent's conv_id up.

Scale: texts are read once and shuffled as ids, by family (a conversation and the
one it borrows turns from), then by range.  Shards hold about ``SHARD_TURNS`` turns;
conv_id is part of the range key, so a group of equal conversations spreads over
shards.  What is recombined is as long as the shards' number times two paths.  The
conv_ids that end at a boundary node are digested in order by a task that streams
them and holds one shard's share.  A conversation's path is one row: 20 bytes a turn.

Defined cases: rows with a null conv_id belong to no conversation and are left out.
A null role or text is empty.  Turns go by turn number, null first, ties by role, then
by id; repeated rows are turns of their own.  ``%`` has the sign of the dividend.  An
empty table has no nodes, not even a root.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import c, written
from tessera.llm.words import ranges

#: Columns that are padded at once.
WIDTH = 64
#: Turns of a shard, about.
SHARD_TURNS = 1 << 20
#: Conversations of a family, and most turns but one that are borrowed from its first.
FAMILY, BORROWED = 5, 9
ID_BYTES = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_SHARD = pa.schema([
    ("shard", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.binary()), ("first", pa.bool_()), ("last", pa.bool_()),
    ("parent_side", pa.string()), ("first_path", pa.binary()), ("last_path", pa.binary()), ("first_bytes", pa.list_(pa.int64())),
])
SHARD_SCHEMA = (
    "shard long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string, ends binary, "
    "first boolean, last boolean, parent_side string, first_path binary, last_path binary, first_bytes array<long>"
)


def paths(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation its turns: conv, path (ids of 16 bytes), bytes (of each turn's text)."""
    r, t, k = F.coalesce(c(role).cast("string"), F.lit("")), F.coalesce(c(text).cast("string"), F.lit("")), c(conv).cast("long")
    one = F.struct(c(turn).alias("turn"), r.alias("role"), F.md5(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t)).alias("id"), F.octet_length(t).alias("bytes"))
    rows = conversations.select(k.alias("conv"), (k - k % FAMILY).alias("family"), one.alias("one")).where("conv IS NOT NULL").repartition("family")
    whole = rows.groupBy("family", "conv").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    return whole.select("family", "conv", F.transform("turns", lambda x: F.struct(x["id"], x["bytes"])).alias("turns"))


def rebuilt(conversations: DataFrame, **columns: str) -> DataFrame:
    """The paths of the rebuilt conversations: turns of the family's first, then the own ones after them."""
    whole = paths(conversations, **columns)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).cast("int")
    head = F.max(F.when(F.col("conv") == F.col("family"), F.slice("turns", 1, BORROWED - 1))).over(Window.partitionBy("family"))
    whole = whole.withColumn("h", h).withColumn("head", F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.slice("turns", 1, 0)))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    whole = whole.select("conv", F.concat("head", own).alias("turns"))
    return whole.select("conv", F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), "")).alias("path"), F.transform("turns", lambda x: x["bytes"]).alias("bytes"))


def sort_paths(codes: np.ndarray, starts: np.ndarray, lens: np.ndarray, conv: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the paths by (turn numbers, conv), and how many turns each shares with the one before it (the first: -1)."""
    n = len(lens)
    order, shared = np.arange(n), np.zeros(n, np.int64)
    at, pos, group = 0, np.arange(n), np.zeros(n, np.int64)
    while len(pos):
        rows = order[pos]
        have = np.clip(lens[rows] - at, 0, width)
        matrix = np.full((len(rows), width), -1, np.int64)
        matrix[np.repeat(np.arange(len(rows)), have), ranges(np.zeros(len(rows), np.int64), have)] = codes[ranges(starts[rows] + at, have)]
        k = np.lexsort((conv[rows], lens[rows] > at + width, *matrix.T[::-1], group))
        rows, matrix = rows[k], matrix[k]
        order[pos] = rows
        alike = group[1:] == group[:-1]
        differs = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
        same = width - differs.sum(axis=1)
        shared[pos[1:][alike]] = at + same[alike]
        more = lens[rows] > at + width
        on = alike & (same == width) & more[1:] & more[:-1]  # this row and the one before go on together
        keep = np.zeros(len(rows), bool)
        keep[1:] |= on
        keep[:-1] |= on
        group = np.cumsum(np.concatenate([[True], ~on]))[keep]
        pos, at = pos[keep], at + width
    ordered = lens[order]
    shared[1:] = np.minimum(shared[1:], np.minimum(ordered[1:], ordered[:-1]))
    shared[:1] = -1
    return order, shared


def _numbers(ids: np.ndarray) -> np.ndarray:
    """A number per id of two 64-bit halves, in the order of the ids."""
    k = np.lexsort((ids[:, 1], ids[:, 0]))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[k][1:] != ids[k][:-1]).any(axis=1)
    out = np.empty(len(ids), np.int64)
    out[k] = np.cumsum(new)
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_nodes(shard: int, conv: np.ndarray, path: pa.Array, size: pa.Array) -> Iterator[pa.RecordBatch]:
    """The nodes of the paths of one shard; those that touch its first or last row are open to that side."""
    lens = np.asarray(pc.binary_length(path), np.int64) // ID_BYTES
    starts = np.cumsum(lens) - lens
    ids = np.frombuffer(b"".join(path.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    total = np.concatenate([[0], np.cumsum(np.asarray(size.flatten(), np.int64))])
    order, shared = sort_paths(_numbers(ids), starts, lens, conv)
    conv, lens, starts = conv[order], lens[order], starts[order]
    n = len(conv)
    following = np.append(shared[1:], -1)
    leaf = following < lens
    deep = np.maximum(shared, following)  # to this depth a row's nodes have other rows too, or may have
    deep[[0, -1]] = lens[[0, -1]]
    upto = total[starts + np.maximum(shared, 0)]
    above, left, right = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)  # of each row's node at the last depth: conv_id, open to the left, to the right

    def batch(depth, conv_, parent, side, n_convs, children, leaves, saved, sha, ends, first, last) -> pa.RecordBatch:
        k, none = len(conv_), pa.nulls(len(conv_))
        cols = [np.full(k, shard), depth, conv_, parent, n_convs, children, leaves, saved, sha, ends, first, last, side, none, none, none]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) if not isinstance(x, pa.Array) else x.cast(f.type) for x, f in zip(cols, _SHARD, strict=True)], schema=_SHARD)

    rows = np.arange(n)
    for d in range(int(deep.max()) + 1):
        rows = rows[deep[rows] >= d]
        st = np.flatnonzero(shared[rows] < d)
        end = np.append(st[1:], len(rows))
        begin, sh = rows[st], shared[rows]
        low = np.minimum.reduceat(conv[rows], st)
        children = np.add.reduceat(((lens[rows] > d) & (sh <= d)).astype(np.int64), st)
        saved = np.add.reduceat(np.where(sh >= max(d, 1), upto[rows] - total[starts[rows] + max(d - 1, 0)], 0), st)
        first, last = begin == 0, rows[end - 1] == n - 1
        over = np.flatnonzero(np.add.reduceat((lens[rows] == d).astype(np.int64), st))
        sha, ends = [None] * len(st), [None] * len(st)
        for k in over.tolist():  # rows that end here come first in their node, by conv_id
            at = rows[st[k] : end[k]]
            listed = _joined(conv[at[lens[at] == d]])
            if first[k] or last[k]:
                ends[k] = listed
            else:
                sha[k] = hashlib.sha256(listed).hexdigest()
        parent = pa.array(above[begin]) if d else pa.nulls(len(st), pa.int64())
        side = pa.array(np.where(left[begin], "f", np.where(right[begin], "l", "-")).tolist()) if d else pa.nulls(len(st), pa.string())
        yield batch(np.full(len(st), d), low, parent, side, end - st, children, np.add.reduceat(leaf[rows].astype(np.int64), st), saved, pa.array(sha, pa.string()), pa.array(ends, pa.binary()), first, last)
        which = np.repeat(np.arange(len(st)), end - st)
        above[rows], left[rows], right[rows] = low[which], first[which], last[which]
    # The depths that a row has to itself.
    alone = lens - deep
    row, depth = np.repeat(np.arange(n), alone), ranges(deep + 1, alone)
    if len(row):
        top, end = depth == deep[row] + 1, depth == lens[row]
        sha = np.full(len(row), None, object)
        sha[end] = [hashlib.sha256(str(x).encode()).hexdigest() for x in conv[row[end]].tolist()]
        side = np.where(top & left[row], "f", np.where(top & right[row], "l", "-"))
        one, no = np.ones(len(row), np.int64), np.zeros(len(row), bool)
        yield batch(depth, conv[row], np.where(top, above[row], conv[row]), pa.array(side.tolist()), one, (~end).astype(np.int64), one, np.zeros(len(row), np.int64), pa.array(sha.tolist(), pa.string()), pa.nulls(len(row), pa.binary()), no, no)
    edge = dict.fromkeys(_SHARD.names) | {
        "shard": shard, "first_path": path[int(order[0])].as_py(), "last_path": path[int(order[-1])].as_py(), "first_bytes": (total[starts[0] : starts[0] + lens[0] + 1] - total[starts[0]]).tolist(),
    }
    yield pa.RecordBatch.from_pylist([edge], _SHARD)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = pa.Table.from_batches(list(batches)) if (batches := [x for x in batches if x.num_rows]) else None
    if got is not None:
        got = got.combine_chunks()
        yield from shard_nodes(TaskContext.get().partitionId(), np.asarray(got["conv"]), got["path"].chunk(0), got["bytes"].chunk(0))


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many turns the first path of a shard shares with the last one before it (-1: there is none)."""
    for batch in batches:
        both = zip(batch.column("first_path").to_pylist(), batch.column("before").to_pylist(), strict=True)
        shared = []
        for a, b in both:
            if b is None:
                shared.append(-1)
                continue
            n = min(len(a), len(b)) // ID_BYTES * ID_BYTES
            same = (np.frombuffer(a[:n], "u8").reshape(-1, 2) == np.frombuffer(b[:n], "u8").reshape(-1, 2)).all(axis=1)
            shared.append(int(np.logical_and.accumulate(same).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), pa.array(shared, pa.int64()), pa.array([-1 if x is None else len(x) // ID_BYTES for x in batch.column("before").to_pylist()], pa.int64()), batch.column("first_bytes")],
            names=["shard", "common", "before_len", "first_bytes"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per (depth, node) of its parts, which come in order."""
    now, state = None, None
    done: list[tuple] = []
    out = lambda: pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["depth", "node", "digest"])
    for batch in batches:
        for d, k, part in zip(*(batch.column(x).to_pylist() for x in ("depth", "node", "ends")), strict=True):
            if (d, k) != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (d, k), hashlib.sha256(part)
            else:
                state.update(b",")
                state.update(part)
        if len(done) > 10_000:
            yield out()
            done = []
    if now is not None:
        done.append((*now, state.hexdigest()))
        yield out()


def nodes(built: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of ``built`` (conv, path, bytes): a row per node."""
    spark = built.sparkSession
    built = written(built, "trie-paths")
    if shards is None:
        turns = built.agg(F.coalesce(F.sum(F.size("bytes").cast("long")), F.lit(0)) + F.count("*")).first()[0]
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    parts = written(built.repartitionByRange(shards, "path", "conv").mapInArrow(_shards, SHARD_SCHEMA), "trie-shards")
    edges = parts.where("first_path IS NOT NULL").select("shard", "first_path", "first_bytes", F.lag("last_path").over(Window.orderBy("shard")).alias("before"))
    edges = edges.mapInArrow(_common, "shard long, common long, before_len long, first_bytes array<long>")

    # Boundary nodes: those of neighbouring shards that are one, and what both counted.
    open_ = parts.where("first OR last").drop("first_path", "last_path", "first_bytes").join(edges, "shard")
    d, q = F.col("depth"), F.col("common")
    goes_on = F.col("first") & (d <= q)
    less = lambda x: F.when(goes_on & x, 1).otherwise(0)
    twice = F.element_at("first_bytes", F.greatest(q, F.lit(0)).cast("int") + 1) - F.element_at("first_bytes", F.greatest(d, F.lit(1)).cast("int"))
    open_ = open_.withColumn("node", F.sum(F.when(goes_on, 0).otherwise(1)).over(Window.partitionBy("depth").orderBy("shard", F.desc("first")).rowsBetween(Window.unboundedPreceding, 0)))
    open_ = open_.select(
        "shard", "depth", "node", "conv_id", "n_convs", (F.col("n_children") - less(d < q)).alias("n_children"), (F.col("n_leaves") - less(q >= F.col("before_len"))).alias("n_leaves"),
        (F.col("saved") + F.when(goes_on & (q >= F.greatest(d, F.lit(1))), twice).otherwise(0)).alias("saved"), "ends", F.array(F.when(F.col("first"), "f"), F.when(F.col("last"), "l")).alias("sides"), "parent_side",
    )
    open_ = written(open_, "trie-open")
    whole = open_.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved")], F.min(F.struct("shard", "parent_side")).alias("at")
    )
    ends = open_.where("ends IS NOT NULL").select("depth", "node", "shard", "ends").repartition("depth", "node").sortWithinPartitions("depth", "node", "shard")
    whole = written(whole.join(ends.mapInArrow(_digests, "depth long, node long, digest string"), ["depth", "node"], "left"), "trie-boundary")
    seen = open_.select("shard", "depth", "node", F.explode("sides").alias("side")).where("side IS NOT NULL")
    parents = written(seen.join(whole.select("depth", "node", "conv_id"), ["depth", "node"]).select("shard", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), F.col("conv_id").alias("looked_up")), "trie-parents")

    inner = parts.where("depth IS NOT NULL AND NOT first AND NOT last").select("shard", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256", "parent_side")
    outer = whole.select("at.shard", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved", F.col("digest").alias("ends_sha256"), "at.parent_side")
    known = inner.where("parent_side = '-'")
    sought = inner.where("parent_side <> '-'").unionByName(outer).join(parents, ["shard", "depth", "parent_side"], "left").withColumn("parent_conv_id", F.col("looked_up")).drop("looked_up")
    return known.unionByName(sought.select(known.columns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    )

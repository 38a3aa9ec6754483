"""SimHash near-dedup by anchor-point covering.

Method: a 64-bit fingerprint from the XXH64 of all word shingles; anchors from a
covering code (``covering``); each distinct fingerprint is replicated to every
anchor within covering radius plus threshold and compared there with the
fingerprints whose home the anchor is.  Links make components; a document's
component is the smallest doc_id reachable.

Scale: exact copies become one fingerprint before anything is compared, by
partial sums, so a group of copies is one row per task.  A fingerprint has about
72 replicas and at most 2,080 links, whatever the corpus.  An anchor that is home
to more than ``CROWD`` fingerprints is not compared member by member: there each
member names the 65 words within one bit, and all members that share one such
word are linked to the smallest of them.  Two fingerprints within two bits always
share one, and two that share one are within two bits, so this is exact too, and
grows with the members, not with their square.  Components are found by star
contraction over written tables.

Defined cases: null and empty texts have fingerprint zero, as have texts without
words, and link like any other.  Rows may share a doc_id or have none: they are
separate rows of the component; a component of null ids only has a null
component_id.  An empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import covering
from tessera.llm.common import c, fresh, text_hash, written
from tessera.llm.words import blocks, join_words, split_words

SHINGLE = 3
MAX_BITS = 2
CROWD = 1024
#: Shingles whose 64 bits are counted at a time (64 bytes each).
STEP = 1 << 17


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: bit b is 1 if more than half of the shingles' hashes have it."""
    import xxhash

    words = split_words(texts, lower=True)
    joined, row_ends = join_words(words.data, words.start, words.end, words.rows)
    rows = len(texts)
    n = np.diff(words.rows)
    count = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(np.int64))
    # Word places in ``joined``: words of a row are one space apart.
    width = words.end - words.start
    before = np.cumsum(width + 1) - (width + 1)
    row = words.row_of()
    filled = np.cumsum(n > 0) - (n > 0)
    start = before - filled[row]
    end = start + width
    head = np.repeat(words.rows[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    tail = head + np.repeat(np.minimum(n, shingle) - 1, count)
    of = np.repeat(np.arange(rows), count)
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    ones = np.zeros((rows, 64), np.int64)
    for at in range(0, len(head), STEP):
        a, b = start[head[at : at + STEP]].tolist(), end[tail[at : at + STEP]].tolist()
        hashes = np.array([digest(raw[i:j], 42) for i, j in zip(a, b, strict=True)], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r = of[at : at + STEP]
        cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        ones[r[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    over = 2 * ones > count[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, th, fp) of every row; ``th`` tells texts under one id apart, fp is signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            fp = fingerprints_of(batch.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(fp)], names=["id", "th", "fp"])

    rows = docs.select(c(id_col).cast("long").alias("id"), text_hash(c(text)).alias("th"), c(text).alias("text"))
    return rows.mapInArrow(run, "id long, th long, fp long")


def _at_anchors(fps: DataFrame, t: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                fp = batch.column("fp").slice(at, 1 << 14).to_numpy(zero_copy_only=False)
                index, anchor = covering.anchors(fp.view(np.uint64), t)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[index])], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """(u, v) with u > v: links between distinct fingerprints that join all components."""
    homes = written(_at_anchors(fps, 0), "homes")
    crowded = written(homes.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "crowded")
    crowds = not crowded.isEmpty()
    if crowds:
        homes = homes.join(crowded, "anchor", "left_anti")
    visits = _at_anchors(fps, max_bits).select("anchor", F.col("fp").alias("u"))
    homes = homes.select("anchor", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    # Each of a pair visits the other's home, so the larger one's visit is enough.
    out = visits.join(homes, (visits["anchor"] == homes["anchor"]) & (F.col("u") > F.col("v")) & near).select("u", "v")
    if crowds:
        members = visits.join(crowded, "anchor", "left_semi").select(F.col("u").alias("fp")).distinct()
        out = out.unionAll(_links_by_shared_words(members, max_bits))
    return out.distinct()


def _links_by_shared_words(members: DataFrame, max_bits: int) -> DataFrame:
    """Each member linked to the smallest one that has a word within half of ``max_bits`` which the member has within the rest."""
    inner = max_bits // 2
    outer = max_bits - inner
    near, far = ([sum(1 << b for b in x) for r in sizes for x in itertools.combinations(range(64), r)] for sizes in (range(inner + 1), range(inner + 1, outer + 1)))
    signed = lambda masks: F.lit([m - (1 << 64) if m >> 63 else m for m in masks])
    words = lambda masks: members.select("fp", F.explode(F.transform(signed(masks), lambda x: F.col("fp").bitwiseXOR(x))).alias("word"))
    inside = words(near)
    least = inside.groupBy("word").agg(F.min("fp").alias("v"))
    shared = inside.unionAll(words(far)) if far else inside
    return shared.join(least, "word").where("fp != v").select(F.greatest("fp", "v").alias("u"), F.least("fp", "v").alias("v"))


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes of ``edges`` (u > v).

    Alternating large-star and small-star contraction (Kiveris et al., 2014):
    every round hangs nodes on smaller neighbours until each is on its root.
    """
    edges = written(edges.select("u", "v").distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that Spark can split the joins at the nodes that many hang on.
        least = written(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = written(large, "large-stars")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """(doc_id, th, fp, component_id, root) of every row; ``root`` names the component."""
    rows = written(fingerprints(docs, id_col, text, shingle), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    found = components(links(fps, max_bits, crowd))
    rooted = fps.join(found, fps["fp"] == found["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # Only linked fingerprints share a root, so no root is hot by copies.
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = written(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(classes, "fp", "left").select(F.col("id").alias("doc_id"), "th", "fp", "component_id", "root")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (then the smallest text hash).

    Of fully equal rows one stays.
    """
    near = near_duplicates(docs, id_col, text, shingle, max_bits)
    best = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k"))
    th = fresh(docs, "th")
    left = docs.withColumn(th, text_hash(c(text)))
    best_id, best_th = fresh(left, "best_id"), fresh(left, "best_th")
    best = best.select(F.col("k.doc_id").alias(best_id), F.col("k.th").alias(best_th))
    out = left.join(best, c(id_col).cast("long").eqNullSafe(c(best_id)) & (c(th) == c(best_th)), "left_semi")
    return out.dropDuplicates([id_col, th]).select(*[c(x) for x in docs.columns])

"""Hard-negative mining by bounds along a spanning tree of the anchors.

Method: anchors are linked to a minimum spanning tree (by distance).  For a child
anchor a with parent p and any row x, ``<a, x>`` lies within ``|a - p| * |x|`` of
``<p, x>``; so a row's score at the parent, or the interval known for it there, bounds
its score at the child.  Negatives of a (anchor, positive) pair must score inside a
window below the positive's score, and only the best few are wanted, so a row is
rescored at an anchor only if its interval meets the anchor's windows, each from its
worst kept score up.  All other rows hand a wider interval down the tree.  What is
rescored is exact: components are whole numbers.

Plan: one pass finds each anchor's first positives, a second its negatives.  Rows
are read as Arrow batches, cut into blocks of ``ROWS`` rows that meet a tree of up
to ``TREE`` anchors; a task keeps the best few per anchor or window, and a window by
rank merges the tasks' answers.  Trees of anchors are built and stored by Spark
tasks; ``SHIPPED`` bytes of them at most go out with one job, so the driver and a
task hold a bounded block of anchors at any number of them, and each block's answers
are written before the next is read.  The anchors are a stated share of the rows
that meets all rows: the work is rows times anchors, less what the bounds spare.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part.  Missing components of a shorter vector count as 0.  Ties go
to the smaller id.  Each row counts for itself, also with a repeated id, but rows of
an anchor's own id are not its positives; a repeated anchor row answers for itself.
Anchors without positives, and pairs without negatives, have no rows.  Scores are
exact while they fit 53 bits; larger components raise an error.  An empty table gives
an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import c, scratch_path, written

#: Anchors of a tree; rows of a block; bytes of anchors that one job takes along.
TREE, ROWS, SHIPPED = 1024, 4096, 16 << 20
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
SCALE = 256

OUT_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_rows(rows: DataFrame, id_col: str = "vec_id", label: str = "label", vector: str = "embedding", new_label: Column | None = None) -> DataFrame:
    """(id, label, v): the rows that take part, with whole components."""
    x = F.transform(c(vector), lambda e: e.cast("double"))
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    kept = rows.where(c(id_col).isNotNull() & c(label).isNotNull() & c(vector).isNotNull() & good)
    return kept.select(c(id_col).cast("long").alias("id"), (c(label).cast("long") if new_label is None else new_label).alias("label"), F.transform(x, lambda e: F.floor(e * SCALE).cast("long")).alias("v"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors as float64 rows, shorter ones padded with 0."""
    v = batch.column("v")
    n = np.asarray(pc.list_value_length(v), np.int64)
    out = np.zeros((len(n), dim))
    out[np.arange(dim) < n[:, None]] = np.asarray(v.flatten())
    return out


def spanning_tree(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's algorithm: order of visit, each one's parent (the first: -1) and distance to it."""
    n = len(a)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, link, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    norm = (a * a).sum(axis=1)
    k = 0
    for i in range(n):
        order[i], parent[k], edge[k], left[k] = k, link[k], 0.0 if link[k] < 0 else near[k], False
        d = np.sqrt(np.maximum(norm + norm[k] - 2 * (a @ a[k]), 0))
        closer = left & (d < near)
        near[closer], link[closer] = d[closer], k
        if i + 1 < n:
            k = int(np.argmin(np.where(left, near, np.inf)))
    return order, parent, edge


def store_trees(rows: DataFrame, is_anchor: Column, dim: int) -> DataFrame:
    """The anchors as trees: (tree, ids, labels, vectors, order, parent, edge), one row a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TREE):
                part = batch.slice(at, TREE)
                a = _matrix(part, dim)
                order, parent, edge = spanning_tree(a)
                row = {"ids": part.column("id").to_pylist(), "labels": part.column("label").to_pylist(), "vectors": a.tobytes(), "order": order.tolist(), "parent": parent.tolist(), "edge": edge.tolist()}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("vectors", pa.binary()), ("order", pa.list_(pa.int64())), ("parent", pa.list_(pa.int64())), ("edge", pa.list_(pa.float64()))]))

    anchors = rows.where(is_anchor)
    parts = max(1, -(-anchors.count() // TREE))  # neighbours by label and id share a tree
    placed = anchors.repartitionByRange(parts, "label", "id").sortWithinPartitions("label", "id")
    trees = placed.mapInArrow(run, "ids array<long>, labels array<long>, vectors binary, order array<long>, parent array<long>, edge array<double>")
    return written(trees.withColumn("tree", F.monotonically_increasing_id()), "anchor-trees")


class Best:
    """The ``k`` best (score, then smaller id) of each slot, and the score below which a slot takes no more."""

    def __init__(self, slots: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.slots, self.more = slots, [0, []]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.more[1].append((slot, score, ids))
        self.more[0] += len(slot)
        if self.more[0] > 4 * self.k * self.slots + 100_000:
            self.settle()

    def settle(self) -> None:
        if self.more[1]:
            slot, score, ids = (np.concatenate([x, *(m[i] for m in self.more[1])]) for i, x in enumerate((self.slot, self.score, self.id)))
            o = np.lexsort((ids, -score, slot))
            slot, score, ids = slot[o], score[o], ids[o]
            rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
            keep = rank < self.k
            self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
            full = rank == self.k - 1
            self.floor[slot[full]] = np.maximum(self.floor[slot[full]], score[full])
            self.more = [0, []]


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield np.asarray(part.column("id")), np.asarray(part.column("label")), _matrix(part, dim)


def _load(trees: list) -> list[dict]:
    out, base = [], 0
    for t in trees:
        n = len(t["ids"])
        out.append({"base": base, "ids": np.array(t["ids"], np.int64), "labels": np.array(t["labels"], np.int64), "a": np.frombuffer(t["vectors"]).reshape(n, -1), **{k: np.array(t[k]) for k in ("order", "parent", "edge")}})
        base += n
    return out


def _answer(best: Best) -> pa.RecordBatch:
    best.settle()
    return pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.score.astype(np.int64)), pa.array(best.id)], names=["slot", "score", "id"])


def positives(rows: DataFrame, trees: list, dim: int, k: int) -> DataFrame:
    """(slot, score, id): the best other rows of each anchor's label; the slot is the anchor's place in ``trees``."""
    count = sum(len(t["ids"]) for t in trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, best = _load(trees), Best(count, k, np.full(count, -np.inf))
        for ids, labels, x in _blocks(batches, dim):
            for t in loaded:
                for label in np.intersect1d(np.unique(labels), t["labels"]):
                    r, a = np.flatnonzero(labels == label), np.flatnonzero(t["labels"] == label)
                    score = x[r] @ t["a"][a].T
                    score[ids[r][:, None] == t["ids"][a]] = -np.inf
                    at = t["base"] + a
                    if len(r) > k:
                        best.floor[at] = np.maximum(best.floor[at], np.partition(score, len(r) - k, axis=0)[len(r) - k])
                    i, j = np.nonzero((score >= best.floor[at]) & (score > -np.inf))
                    best.add(at[j], score[i, j], ids[r[i]])
        yield _answer(best)

    return rows.mapInArrow(run, "slot long, score long, id long")


def negatives(rows: DataFrame, trees: list, dim: int, slots: np.ndarray, lowest: np.ndarray, highest: np.ndarray, k: int, counter=None) -> DataFrame:
    """(slot, score, id): per slot the best rows of another label than its anchor's with scores in [lowest, highest].

    ``slots`` has the anchor of each slot, ascending.  ``counter`` (an accumulator) gets the rescored pairs.
    """
    count = sum(len(t["ids"]) for t in trees)
    first = np.searchsorted(slots, np.arange(count + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, best, rescored = _load(trees), Best(len(slots), k, lowest), 0
        for ids, labels, x in _blocks(batches, dim):
            norm = np.sqrt((x * x).sum(axis=1))
            for t in loaded:
                low, high = {}, {}
                children = np.bincount(t["parent"][t["parent"] >= 0], minlength=len(t["ids"]))
                for j in t["order"].tolist():
                    p, s, e = int(t["parent"][j]), first[t["base"] + j], first[t["base"] + j + 1]
                    if p < 0:
                        lo, hi = np.full(len(x), -np.inf), np.full(len(x), np.inf)
                    else:
                        reach = t["edge"][j] * norm * (1 + 1e-9) + 1e-3  # more than rounding can add
                        lo, hi = low[p] - reach, high[p] + reach
                    if s < e:
                        need = (hi >= best.floor[s:e].min()) & (lo <= highest[s:e].max())
                    else:
                        need = np.zeros(len(x), bool)
                    if p < 0:
                        need[:] = True
                    r = np.flatnonzero(need)
                    if len(r):
                        score = x[r] @ t["a"][j]
                        rescored += len(r)
                        lo[r] = hi[r] = score
                        other = labels[r] != t["labels"][j]
                        r, score = r[other], score[other]
                        for g in range(s, e):
                            hit = np.flatnonzero((score >= best.floor[g]) & (score <= highest[g]))
                            if len(hit) > 8 * k:  # the best few and their ties
                                hit = hit[score[hit] >= np.partition(score[hit], len(hit) - k)[len(hit) - k]]
                            if len(hit):
                                if len(hit) >= k:
                                    best.floor[g] = max(best.floor[g], np.partition(score[hit], len(hit) - k)[len(hit) - k])
                                best.add(np.full(len(hit), g), score[hit], ids[r[hit]])
                    if children[j]:
                        low[j], high[j] = lo, hi
                    if p >= 0:
                        children[p] -= 1
                        if not children[p]:
                            del low[p], high[p]
        if counter is not None:
            counter.add(rescored)
        yield _answer(best)

    return rows.mapInArrow(run, "slot long, score long, id long")


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, counter=None) -> DataFrame:
    """The hard negatives of ``rows`` (id, label, v); ``is_anchor`` is a condition on them."""
    spark = rows.sparkSession
    rows = written(rows, "mining-rows")
    sizes = rows.agg(F.max(F.size("v")).alias("dim"), F.max(F.reduce("v", F.lit(0).cast("long"), lambda m, e: F.greatest(m, F.abs(e)))).alias("top")).first()
    dim = sizes["dim"] or 0
    if dim * float(sizes["top"] or 0) ** 2 >= 1 << 53:
        raise ValueError("scores of these vectors do not fit 53 bits")
    trees = store_trees(rows, is_anchor, dim)
    a_tree = trees.select("tree", (F.length("vectors") + 40 * F.size("ids")).alias("n")).orderBy("tree").toLocalIterator()
    path, jobs = scratch_path(spark, "mined"), 0

    def job(names: list) -> None:
        held = [r.asDict() for r in trees.where(F.col("tree").isin(names)).orderBy("tree").collect()]  # SHIPPED bytes, or one tree
        own = np.concatenate([t["ids"] for t in held])
        got = _first(positives(rows, held, dim, n_positives), n_positives).orderBy("slot", "rank").collect()  # a few per held anchor
        slots, score, ids = (np.array([r[x] for r in got], np.int64) for x in ("slot", "score", "id"))
        lowest, highest = -(-window[0] * score // 100), window[1] * score // 100
        found = _first(negatives(rows, held, dim, slots, lowest, highest, n_negatives, counter), n_negatives)
        pairs = spark.createDataFrame(pa.table({"slot": pa.array(np.arange(len(slots))), "anchor_id": pa.array(own[slots].astype(np.int64)), "positive_id": pa.array(ids), "positive_score": pa.array(score)}))
        found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(pairs, "slot").select(*[x.split()[0] for x in OUT_SCHEMA.split(", ")]).write.parquet(f"{path}/job={jobs}")

    some, size = [], 0
    for t in a_tree:
        if some and size + t["n"] > SHIPPED:
            job(some)
            some, size, jobs = [], 0, jobs + 1
        some.append(t["tree"])
        size += t["n"]
    if some:
        job(some)
        jobs += 1
    if not jobs:
        return spark.createDataFrame([], OUT_SCHEMA)
    return spark.read.schema(OUT_SCHEMA).parquet(*(f"{path}/job={k}" for k in range(jobs)))

"""Mixing sources to target weights by a low-discrepancy schedule of slots.

Method: each source has a target, a number of words that the mix takes from it.
Its documents are shuffled (by a digest of seed and doc_id) and laid one after the
other; that stream is cut into blocks of equally many words.  A source takes as
many slots of the mix as its target has blocks: the whole stream once per full
epoch, then a last epoch that stops at the target.  The N slots of the mix are the
golden-ratio points ``i * g mod N`` (``g`` next to N over the golden ratio and
coprime to N, so each of N places is met once, in an order of low discrepancy);
the sources' slot counts, summed up, cut the places into intervals, and the
interval in which a point falls names the slot's source.  A slot's rank among
those of its source says which block of which epoch it holds, and that is joined
with the pieces of documents in the block.  So any run of slots has the sources
near their weights, and all slots together have exactly the (rounded) targets.

Targets: the sources in code-point order, null last, have the given weights in
turn, and share ``share`` of all words by weight; what a source would get above
``most`` times its size is shared by weight among the others until none is above.

Scale: DataFrame operations only.  Texts are read once, for their sizes; later
steps read a written table of ids and sizes.  Running sums (documents of a source,
slots of a source, sources) are taken in two steps, inside buckets and over bucket
totals, so that a hot source is spread over about as many buckets as the square
root of the rows.  Nothing is broadcast by hand and the driver gets a few sums: a
round of the sharing is one aggregate over the sources.  Points meet intervals
by an equality join on cells, blocks meet slots by (source, block).

Defined cases: a null or empty text has size 0 and is taken 0 times, also when the
whole source has no words (target 0).  Each row is a document of its own, also with
a null or repeated doc_id; of equal rows the pieces may change places.  A source may
be null or empty text; each is a source.  Ties in the shuffle go by doc_id, then
size.  An empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import c, written
from tessera.operators.paging import rank_rows

#: Words of a block.
BLOCK = 2048
#: Weights of the sources, in turn.
WEIGHTS = (3, 1, 2)
#: Words of the mix over those of all documents; most words of a source over its size.
SHARE, MOST = 1.5, 2.0

_BEFORE = Window.unboundedPreceding, -1


def div(a: Column, b: Column) -> Column:
    """Whole quotient of longs; null where ``b`` is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_sum(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the earlier rows of the same keys.

    Rows are ordered by (bucket, order).  A window sums inside a bucket, another
    over the totals of the buckets, so no task holds all rows of a key.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(*_BEFORE)
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_t"))
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*_BEFORE)
    totals = totals.withColumn("_o", F.coalesce(F.sum("_t").over(over), F.lit(0))).drop("_t")
    out = df.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(totals, [*keys, bucket])
    return out.withColumn(name, F.col("_i") + F.col("_o")).drop("_i", "_o")


def step_of(n: int) -> int:
    """A number next to n over the golden ratio and coprime to n."""
    g = max(1, round(n * (math.sqrt(5) - 1) / 2))
    while math.gcd(g, n) > 1:
        g += 1
    return g


def times_mod(i: Column, g: int, n: int) -> Column:
    """``i * g mod n`` without overflow for n up to 2^41."""
    low = 1 << 21
    return F.pmod(div(i, F.lit(low)) * F.lit(g * low % n) % n + F.pmod(i, F.lit(low)) * F.lit(g), F.lit(n))


@dataclass
class Mix:
    documents: DataFrame  # row, doc_id, size, source, s, source_size, target, start (in the source's stream)
    sources: DataFrame  # source, s, source_size, weight, target, words (taken), blocks, slots, first (place)
    slots: DataFrame  # position, s, epoch, block, words
    schedule: DataFrame  # position, s, epoch, block, row, doc_id, from, to: words [from, to) of the document


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with their number ``s``, weight and target."""
    ranked = rank_rows(sources, [F.col("source").isNull(), "source"], "s", ranges=None)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    numbered = written(ranked.withColumn("weight", weight), "mix-sources")
    cap, level, capped = most * F.col("source_size"), None, -1
    while True:  # each round caps one source more at least
        over = F.lit(False) if level is None else level * F.col("weight") > cap
        got = numbered.agg(
            F.sum("source_size").alias("all"), F.count_if(over).alias("capped"), F.sum(F.when(over, cap)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open")
        ).first()
        if got["capped"] == capped or not got["open"]:
            break
        capped, level = got["capped"], (share * (got["all"] or 0) - (got["full"] or 0.0)) / got["open"]
    reach = cap if level is None else F.least(cap, F.lit(level) * F.col("weight"))
    return numbered.withColumn("target", F.greatest(reach, F.lit(0.0)))


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 42, id_col: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    sized = written(
        docs.select(F.monotonically_increasing_id().alias("row"), c(id_col).alias("doc_id"), c(source).cast("string").alias("source"), n_words(c(text)).alias("size")), "mix-sizes"
    )
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    size, b = F.col("source_size"), F.lit(block)
    plan = plan.withColumn("words", F.floor(F.col("target") + 0.5).cast("long")).withColumn("blocks", F.ceil(size / b).cast("long"))
    full = F.coalesce(div(F.col("words"), size), F.lit(0))
    last = F.col("words") - full * size
    plan = plan.withColumn("slots", full * F.col("blocks") + F.ceil(last / b).cast("long")).withColumn("part", div(F.col("s"), F.lit(1024)))
    plan = written(running_sum(plan, [], "part", ["s"], "slots", "first").drop("part"), "mix-plan")
    sums = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("slots"), F.count("*").alias("sources")).first()
    n = max(1, sums["slots"])

    # The places of the sources, by cells that a point can be joined with.
    width = max(1, n // max(math.isqrt(n), sums["sources"], 1))
    cells = plan.where("slots > 0").withColumn("cell", F.explode(F.sequence(div(F.col("first"), F.lit(width)), div(F.col("first") + F.col("slots") - 1, F.lit(width)))))
    points = docs.sparkSession.range(sums["slots"]).select(F.col("id").alias("position"), times_mod(F.col("id"), step_of(n), n).alias("place")).withColumn("cell", div(F.col("place"), F.lit(width)))
    met = points.join(cells, "cell").where("place >= first AND place < first + slots")
    met = met.select("position", "s", "source_size", "words", "blocks", F.lit(1).cast("long").alias("one"), div(F.col("position"), F.lit(max(1, math.isqrt(n)))).alias("part"))
    ranked = running_sum(met, ["s"], "part", ["position"], "one", "rank")
    epoch, k = div(F.col("rank"), F.col("blocks")), F.col("rank") % F.col("blocks")
    end = F.least((k + 1) * b, size, F.col("words") - epoch * size)
    slots = ranked.select("position", "s", epoch.alias("epoch"), k.alias("block"), (end - k * b).alias("words"))

    # The documents of a source, shuffled, one after the other.
    rows = sized.join(plan.select("source", "s", "source_size", "target"), sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    digits = max(1, math.ceil(math.log(max(sized.count(), 2), 16) / 2))
    rows = rows.withColumn("at", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))).withColumn("part", F.substring("at", 1, digits))
    rows = running_sum(rows, ["s"], "part", ["at", "doc_id", "size"], "size", "start").drop("at", "part")
    first, stop = F.col("start"), F.col("start") + F.col("size")
    pieces = rows.withColumn("block", F.when(F.col("size") > 0, F.sequence(div(first, b), div(stop - 1, b)))).withColumn("block", F.explode_outer("block"))
    out = pieces.join(slots.withColumnRenamed("words", "held"), ["s", "block"], "left")
    begin = F.greatest(first, F.col("block") * b)
    until = F.least(stop, F.col("block") * b + F.coalesce(F.col("held"), F.lit(0)))
    out = out.withColumn("from", F.coalesce(begin - first, F.lit(0))).withColumn("to", F.greatest(F.coalesce(until - first, F.lit(0)), F.col("from")))
    return Mix(rows, plan, slots, out.drop("held"))


def taken(mixed: Mix) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken (words, repeats counted)."""
    keys = ["row", "doc_id", "size", "source", "source_size", "target"]
    return mixed.schedule.groupBy(*keys).agg(F.sum(F.col("to") - F.col("from")).alias("taken")).drop("row")

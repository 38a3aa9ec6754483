"""Substring dedup: recurring passages are found by Aho-Corasick automata and cut.

A window is 20 consecutive words of one text.  A word goes when a window that
covers it has the same words as a window that starts earlier (smaller doc_id, or
same doc_id and earlier place).  Windows are judged on the input.

Method:

1. Seeds.  Of the 6-word phrases in a window, the one with the least hash is its
   seed (winnowing), so equal windows have equal seeds, and about one phrase in
   eight is a seed.  Seeds found twice or more may lie in recurring passages; all
   other text is out at this point, at 8 bytes a seed.
2. Segments.  Each text is read again with its recurring seeds; runs of windows
   with one seed become segments, and equal segments one row with their number
   and first place (summed before the shuffle, so a passage of a third of all
   documents is one row per task).
3. Automata.  The distinct segments of a set of seeds form a shard of bounded
   size.  A task confirms the shard's recurring windows (equal words, not equal
   hashes), compiles them into an Aho-Corasick automaton over word numbers, and
   streams the shard's distinct segments through it: every window of them comes out
   with the phrase's first place.  The texts themselves are not streamed: each
   occurrence in them is found by a join on the hash of its segment, since equal
   segments have equal windows and one answer serves all of them.
4. Cut.  Occurrences after the first mark their words; each text is read a last
   time and its kept words are joined by one space.

Scale: texts are shuffled once, into a table bucketed by row, which steps 2 and 4
read without a shuffle.  A seed with more distinct segments than a shard holds
(a common phrase in many contexts) is split: its windows become segments of their
own and go to shards by their own words.

Defined cases: null and empty texts have no words.  A null doc_id comes before all
others.  Rows with one doc_id are ordered by word position only, so equal places
of such rows keep each other; fully equal rows get equal results.  Texts under 20
words lose nothing.  An empty table gives an empty result.  Extra columns are not
read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import c, scratch_path, text_hash, written
from tessera.llm.words import Words, blocks, join_words, ranges, split_words

WINDOW, SEED = 20, 6
#: Distinct segments in a shard (up to 15 windows of 20 words each).
SHARD_SEGMENTS = 3000
#: Bytes from which a word is hashed by itself.
LONG_WORD = 64
#: Text looked at together; numpy takes about 20 times as much.
BLOCK_BYTES = 2 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Stands for a null doc_id: before all ids.
NULL_ID = -(2**63)


def _word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, byte place by byte place for all words.

    Equal words have equal hashes; unequal ones that collide only make text a
    candidate that the automata then refuse.
    """
    import xxhash

    length = words.end - words.start
    short = np.minimum(length, LONG_WORD).astype(np.uint8)
    order = np.argsort(~short, kind="stable")  # longest first
    start, h = words.start[order], np.full(len(order), 0x9E3779B97F4A7C15, np.uint64)
    longer = np.cumsum(np.bincount(short, minlength=LONG_WORD + 1)[::-1])[::-1]
    for k in range(LONG_WORD):
        m = int(longer[k + 1])
        if not m:
            break
        h[:m] = h[:m] * np.uint64(0x100000001B3) + words.data[start[:m] + k] + np.uint64(1)
    for i in range(int(longer[LONG_WORD])):
        h[i] = xxhash.xxh64_intdigest(words.data[start[i] : words.end[order[i]]].tobytes())
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    out = np.empty(len(h), np.uint64)
    out[order] = h ^ (h >> np.uint64(32))
    return out


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``n`` neighbours; len(x) - n + 1 values."""
    have, out = 1, x
    while have < n:
        step = min(have, n - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def window_seeds(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed of the window at each word (_NONE: no window); the words where seeds lie, and those seeds."""
    n = len(words.start)
    seeds = np.full(n, _NONE)
    if n < WINDOW:
        return seeds, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _word_hashes(words)
    grams = np.zeros(n - SEED + 1, np.uint64)
    for k in range(SEED):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k : n - SEED + 1 + k]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    grams = np.minimum(grams, _NONE - np.uint64(1)) | np.uint64(1)
    row_end = np.repeat(words.rows[1:], np.diff(words.rows))
    whole = np.arange(n - WINDOW + 1) + WINDOW <= row_end[: n - WINDOW + 1]
    least = _sliding(grams, WINDOW - SEED + 1, np.minimum)
    seeds[: n - WINDOW + 1][whole] = least[whole]
    # A phrase is a seed if it is the least of some whole window around it.
    pad = np.zeros(WINDOW - SEED, np.uint64)
    most = _sliding(np.concatenate([pad, np.where(whole, least, 0), pad]), WINDOW - SEED + 1, np.maximum)
    places = np.flatnonzero(grams == most)
    return seeds, places, grams[places]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _seed_rows(rows: DataFrame) -> DataFrame:
    """(rk, seed, n) of the seeds of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            words = split_words(batch.column("text"))
            _, at, value = window_seeds(words)
            row = words.row_of()[at]
            key = np.lexsort((value, row))
            row, value = row[key], value[key]
            cut = _changes(row, value)
            n = np.diff(np.append(cut, len(row)))
            rk = batch.column("rk").take(pa.array(row[cut]))
            yield pa.RecordBatch.from_arrays([rk, pa.array(value[cut].view(np.int64)), pa.array(n, pa.int32())], names=["rk", "seed", "n"])

    return rows.select("rk", "text").mapInArrow(run, "rk long, seed long, n int")


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` as a table bucketed by ``key``: joins on it read it without a shuffle.

    The catalog entry goes at once; the frame has resolved it, and the files of
    a table with a path of its own stay.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tessera_{uuid.uuid4().hex}"
    writer = rows.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd")
    writer.option("path", scratch_path(spark, "bucketed")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


SEGMENT_SCHEMA = "id long, th long, at long, seed long, piece string"


def _segments(seeded: DataFrame) -> DataFrame:
    """Runs of windows with one recurring seed: place, seed and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            words = split_words(batch.column("text"))
            seeds, _, _ = window_seeds(words)
            row = words.row_of()
            wanted = np.unique(batch.column("seeds").flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
            hit = np.isin(seeds, wanted)
            first = _changes(row, seeds)
            first = first[hit[first]]
            if not len(first):
                continue
            ends = np.append(_changes(row, seeds), len(row))
            last = ends[np.searchsorted(ends, first, side="right")]  # the word after the run's last window start
            count = last - first + WINDOW - 1
            at = ranges(first, count)
            body, offsets = join_words(words.data, words.start[at], words.end[at], np.concatenate([[0], np.cumsum(count)]))
            piece = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)).cast(pa.string())
            r = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(r), batch.column("th").take(r), pa.array(first - words.rows[row[first]], pa.int64()), pa.array(seeds[first].view(np.int64)), piece],
                names=[x.split()[0] for x in SEGMENT_SCHEMA.split(", ")],
            )

    return seeded.select("id", "th", "text", "seeds").mapInArrow(run, SEGMENT_SCHEMA)


def _piece_key() -> list[Column]:
    return [F.xxhash64("piece").alias("p1"), F.xxhash64(F.lit(1), "piece").alias("p2")]


def _split_hot(segments: DataFrame, shard_segments: int) -> DataFrame:
    """Segments of seeds with too many distinct ones, window by window; (.., route) of all."""
    hot = written(segments.select("seed", *_piece_key()).distinct().groupBy("seed").count().where(F.col("count") > shard_segments).select("seed"), "hot-seeds")
    routed = segments.withColumn("route", F.col("seed"))
    if hot.isEmpty():
        return routed
    words = F.split("piece", " ")
    starts = F.sequence(F.lit(1), F.size("words") - WINDOW + 1)
    windows = F.transform(starts, lambda i: F.array_join(F.slice(F.col("words"), i, F.lit(WINDOW)), " "))
    cut = segments.join(hot, "seed", "left_semi").withColumn("words", words).select("id", "th", F.col("at").alias("from"), "seed", F.posexplode(windows).alias("k", "piece"))
    cut = cut.select("id", "th", (F.col("from") + F.col("k")).alias("at"), "seed", "piece").withColumn("route", F.xxhash64("piece"))
    return routed.join(hot, "seed", "left_anti").unionByName(cut)


def _may_repeat_itself(words: tuple[int, ...]) -> bool:
    """False if no window of the segment can occur in it twice.

    Windows that are equal ``d`` words apart have at most ``d`` different words
    between them, so the segment has ``len - WINDOW`` at most.
    """
    return len(words) > 2 * WINDOW - SEED or len(set(words)) <= len(words) - WINDOW


def find_phrases(seeds: list[int], pieces: list[str], counts: list[int], firsts: list[tuple[int, int]]) -> list[list[tuple[int, int] | None]]:
    """Per segment and window: the first place of a recurring window's words, or None.

    The segments are those of one shard: all that may share a window.  Windows
    are shared only between segments of one seed, so the only segment of a seed
    recurs as a whole or not at all: it is one phrase.  Otherwise each recurring
    window is a phrase.
    """
    import ahocorasick

    numbers: dict[str, int] = {}
    coded = [tuple(numbers.setdefault(w, len(numbers)) for w in p.split(" ")) for p in pieces]
    of: dict[int, list[int]] = {}
    for i, seed in enumerate(seeds):
        of.setdefault(seed, []).append(i)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for members in of.values():
        i = members[0]
        if len(members) == 1 and not _may_repeat_itself(coded[i]):
            if counts[i] > 1:
                automaton.add_word(coded[i], (len(coded[i]), *firsts[i]))
            continue
        found: dict[tuple[int, ...], list] = {}
        for i in members:
            words, (doc, at) = coded[i], firsts[i]
            for k in range(len(words) - WINDOW + 1):
                have = found.setdefault(words[k : k + WINDOW], [0, (doc, at + k)])
                have[0] += counts[i]
                have[1] = min(have[1], (doc, at + k))
        for window, (n, first) in found.items():
            if n > 1:
                automaton.add_word(window, (WINDOW, *first))
    out: list[list[tuple[int, int] | None]] = [[None] * (len(words) - WINDOW + 1) for words in coded]
    if len(automaton):
        automaton.make_automaton()
        for words, places in zip(coded, out, strict=True):
            for end, (size, doc, at) in automaton.iter(words):
                begin = end - size + 1
                for k in range(size - WINDOW + 1):
                    places[begin + k] = (doc, at + k)
    return out


VERDICT_SCHEMA = "seed long, p1 long, p2 long, first_ids array<long>, first_ats array<long>"


def _verdicts(distinct: DataFrame, shard_segments: int) -> DataFrame:
    """Per distinct segment the first place of each of its windows (null: found once)."""
    shards = max(1, -(-distinct.count() // shard_segments))

    def run(table: pa.Table) -> pa.Table:
        firsts = table.column("first").to_pylist()
        places = find_phrases(table.column("seed").to_pylist(), table.column("piece").to_pylist(), table.column("n").to_pylist(), [(f["id"], f["at"]) for f in firsts])
        ids = [[p and p[0] for p in x] for x in places]
        ats = [[p and p[1] for p in x] for x in places]
        kind = pa.list_(pa.int64())
        return pa.table([table.column("seed"), table.column("p1"), table.column("p2"), pa.array(ids, kind), pa.array(ats, kind)], names=[x.split()[0] for x in VERDICT_SCHEMA.split(", ")])

    sharded = distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    return sharded.groupBy("shard").applyInArrow(run, VERDICT_SCHEMA)


def _cut(rows: DataFrame) -> DataFrame:
    """(id, th, n_words, n_removed, kept) of texts with the places of their removed windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            words = split_words(batch.column("text"))
            n = np.diff(words.rows)
            cuts = batch.column("cuts")
            many = np.asarray(pc.list_value_length(cuts).fill_null(0))
            start = cuts.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.rows[:-1], many)
            cover = np.zeros(len(words.start) + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + WINDOW, -1)
            keep = np.cumsum(cover[:-1]) == 0
            rows = np.concatenate([[0], np.cumsum(keep)])[words.rows]
            body, offsets = join_words(words.data, words.start[keep], words.end[keep], rows)
            kept = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(n - np.diff(rows), pa.int64()), kept], names=["id", "th", "n_words", "n_removed", "kept"])

    return rows.select("id", "th", "text", "cuts").mapInArrow(run, "id long, th long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(doc_id, th, n_words, n_removed, kept) of every row; ``kept`` is the text that stays."""
    rows = docs.select(c(id_col).cast("long").alias("id"), text_hash(c(text)).alias("th"), c(text).alias("text"))
    rows = rows.withColumn("rk", F.xxhash64("id", "th"))
    seeds = _seed_rows(rows)
    recurring = written(seeds.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed"), "recurring-seeds")
    seeded = seeds.join(recurring, "seed", "left_semi").groupBy("rk").agg(F.collect_set("seed").alias("seeds"))
    table = _bucketed(rows.withColumn("id", F.coalesce("id", F.lit(NULL_ID))), "rk")
    segments = written(_segments(table.join(seeded, "rk")), "segments")
    segments = _split_hot(segments, shard_segments)
    distinct = segments.groupBy("seed", "route", "piece").agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("first"))
    distinct = written(distinct.select("*", *_piece_key()), "distinct-segments")
    verdicts = written(_verdicts(distinct, shard_segments), "phrases")
    places = F.sequence(F.lit(0), F.size("first_ids") - 1)
    later = F.filter(
        places,
        lambda k: F.get("first_ids", k).isNotNull()
        & ((F.get("first_ids", k) < F.col("id")) | ((F.get("first_ids", k) == F.col("id")) & (F.get("first_ats", k) < F.col("at") + k))),
    )
    occurrences = segments.select("id", "th", "at", "seed", *_piece_key()).join(verdicts, ["seed", "p1", "p2"])
    cuts = occurrences.select("id", "th", F.transform(later, lambda k: F.col("at") + k).alias("cut")).where(F.size("cut") > 0)
    cuts = cuts.select(F.xxhash64(F.when(F.col("id") != NULL_ID, F.col("id")), "th").alias("rk"), F.col("id").alias("cid"), F.col("th").alias("cth"), "cut")
    cuts = cuts.groupBy("rk", "cid", "cth").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cuts"))
    joined = table.join(cuts, (table["rk"] == cuts["rk"]) & (table["id"] == cuts["cid"]) & (table["th"] == cuts["cth"]), "left")
    out = _cut(joined.select("id", "th", "text", "cuts"))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "th", "n_words", "n_removed", "kept")

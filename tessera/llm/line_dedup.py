"""Line dedup: lines that many documents share are dropped from all of them.

Method: explode the normalised lines, hash them, count the documents per hash,
drop the lines over the threshold, and reassemble each text by line position.
DataFrame functions only.

Plan: the count gets each document's distinct line keys once, and Spark sums
them before the shuffle, so a line that a third of all documents carry is one
row per task there.  The positions then meet the frequent keys in a join of
keys (16 bytes of hash each, no text); Spark broadcasts the frequent side when
it is small and splits hot keys when it is not.  Only the last join moves texts.

Defined cases: null and empty texts are one empty line.  Each row is a document
of its own, also when doc_ids repeat or are null.  A line key is judged by two
64-bit hashes with different seeds (128 bits together).  An empty table gives an
empty result.  Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import c, fresh, text_hash, written

#: Fixed value: the ASCII white space stripped from both ends of a line.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(s: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    ascii_only = F.octet_length(s) == F.char_length(s)
    return F.when(ascii_only, F.lower(s)).otherwise(F.translate(s, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(c(text), F.lit("")), "\n", -1)


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def frequent_lines(docs: DataFrame, text: str = "text", min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """(h1, h2, n_docs) of the line keys that at least ``min_docs`` documents hold."""
    keys = docs.select(F.explode(F.array_distinct(F.transform(_lines(text), line_key))).alias("key"))
    return (
        keys.where(F.char_length("key") >= min_chars)
        .select(*_hashed(F.col("key")))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def drop_frequent_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 1, min_docs: int = 10
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``text`` rebuilt from its kept lines.

    Returns the frame and the names of two added columns, ``n_lines`` (before)
    and ``n_dropped``.  A text of which nothing is dropped stays as it was, a
    null text becomes the empty text.
    """
    # Written, so that the join below is one of two plain exchanges, which Spark can split at hot keys.
    frequent = written(frequent_lines(docs, text, min_chars, min_docs), "frequent-lines")
    lines = docs.select(c(id_col).alias("id"), text_hash(c(text)).alias("th"), F.posexplode(_lines(text)).alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    dropped = (
        lines.select("id", "th", "pos", *_hashed(F.col("key")))
        .join(frequent.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drop"))
    )
    th, drop, n_lines, n_dropped = (fresh(docs, x) for x in ("th", "drop", "n_lines", "n_dropped"))
    left = docs.withColumn(th, text_hash(c(text)))
    other_id, other_th = fresh(left, "other_id"), fresh(left, "other_th")
    dropped = dropped.select(F.col("id").alias(other_id), F.col("th").alias(other_th), F.col("drop").alias(drop))
    joined = left.join(dropped, c(id_col).eqNullSafe(c(other_id)) & (c(th) == c(other_th)), "left")
    count = F.size(_lines(text))
    stay = F.array_except(F.sequence(F.lit(0), count - 1), c(drop))
    parts = fresh(docs, "parts")
    out = joined.withColumn(parts, _lines(text))
    rebuilt = F.when(c(drop).isNull(), F.coalesce(c(text), F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(c(parts), i)), "\n")
    )
    out = (
        out.withColumn(n_lines, F.size(c(parts)).cast("long"))
        .withColumn(n_dropped, F.coalesce(F.size(c(drop)), F.lit(0)).cast("long"))
        .withColumn(text, rebuilt)
    )
    keep = [*docs.columns, n_lines, n_dropped]
    return out.select(*[c(x) for x in keep]), {"n_lines": n_lines, "n_dropped": n_dropped}

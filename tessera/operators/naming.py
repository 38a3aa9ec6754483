"""Dataset name -> id resolution inside saved query texts.

Every quoted ``load "name"`` target whose name is in the registry becomes the
dataset id; unknown names stay; a text may load several datasets, the same
one more than once.  Only quoted load targets change, and the match is
literal (no regex built from the name).

Plan: split each text on ``"`` (odd segments are inside quotes) and mark the
segments that follow ``load``; explode only those and join them to the
registry (AQE picks broadcast or sort-merge and splits a hot name); collect
each text's substitutions with ``collect_set`` grouped by (key, hashes), so a
group holds the loads of one text and identical copies are combined
map-side; join the substitutions back and rewrite each text with a
``transform`` over its own segments.  Nothing assumes the key is unique: a text
is known by its key and two 64-bit hashes with different seeds, so no text is
shuffled but the rewritten ones, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text before a quoted dataset target.
LOAD_BEFORE = r"(^|[^A-Za-z0-9_])load\s*$"


def _text_id(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")


def resolve_dataset_names(
    queries: DataFrame,
    registry: DataFrame,
    key: str = "query_id",
    text: str = "query",
    name: str = "name",
    dataset_id: str = "dataset_id",
) -> DataFrame:
    """``queries`` with ``text`` rewritten; other columns are kept."""
    parts = F.split(F.col(text), '"', -1)
    n = F.size(parts)

    def mark(seg, i):
        prev = F.when(i > 0, F.element_at(parts, F.greatest(i, F.lit(1))))
        target = (i % 2 == 1) & (i < n - 1) & F.coalesce(prev.rlike(LOAD_BEFORE), F.lit(False))
        return F.struct(i.alias("pos"), seg.alias("seg"), target.alias("is_target"))

    targets = queries.select(
        F.col(key), *_text_id(F.col(text)), F.explode(F.filter(F.transform(parts, mark), lambda m: m["is_target"])).alias("t")
    ).select(key, "_h1", "_h2", "t.pos", "t.seg")
    # A name listed twice resolves to its smallest id, so the answer is stable.
    reg = registry.groupBy(F.col(name).alias("seg")).agg(F.min(dataset_id).alias("_id"))
    subs = (
        targets.join(reg, "seg")
        .groupBy(key, "_h1", "_h2")
        .agg(F.map_from_entries(F.collect_set(F.struct(F.col("pos"), F.col("_id")))).alias("_subs"))
    )
    q, s = queries.alias("_q"), subs.alias("_s")
    # Null-safe on the key: a text without a key is rewritten too.
    h1, h2 = _text_id(F.col(f"_q.{text}"))
    cond = F.col(f"_q.{key}").eqNullSafe(F.col(f"_s.{key}")) & (h1 == F.col("_s._h1")) & (h2 == F.col("_s._h2"))
    joined = q.join(s, cond, "left")
    q_parts = F.split(F.col(f"_q.{text}"), '"', -1)
    rewritten = F.when(F.col("_s._subs").isNull(), F.col(f"_q.{text}")).otherwise(
        F.array_join(F.transform(q_parts, lambda seg, i: F.coalesce(F.element_at(F.col("_s._subs"), i), seg)), '"')
    )
    return joined.select(*[rewritten.alias(c) if c == text else F.col(f"_q.{c}").alias(c) for c in queries.columns])


def load_targets(queries: DataFrame, key: str = "query_id", text: str = "query") -> DataFrame:
    """``(query_id, pos, name)`` of every quoted load target."""
    return queries.select(
        key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r'load\s*"([^"]*)"'), 1)).alias("pos", "name")
    )

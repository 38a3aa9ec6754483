"""Keyed writes on an object table: insert, update, upsert.

A key is one column or several.  Plans are joins Catalyst and AQE can re-plan.
``build_source``: the change set (``src``) is the build side of every join, so a
small change set is broadcast once AQE has measured it and the target is then
not shuffled (a larger one falls back to sort-merge); the target is never
broadcast.  ``full_outer``: one full outer join, one shuffle per side, for a
large change set.  Rows whose key has a null never match: they are split off on
both sides before any join, instead of being hashed into one reducer.

Blank handling: ``blanks="keep"`` leaves the target value where the source
value is null or ``""`` (empty fields are ignored on update);
``blanks="overwrite"`` writes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MATCH = "_tessera_matched"


def insert(target: DataFrame, src: DataFrame) -> DataFrame:
    """Append source rows; target columns absent from the source are null."""
    return target.unionByName(src, allowMissingColumns=True)


def key_list(key: str | list[str]) -> list[str]:
    keys = [key] if isinstance(key, str) else list(key)
    if not keys:
        raise ValueError("a key needs a column")
    return keys


def whole_key(keys: list[str]) -> Column:
    """True where no column of the key is null."""
    out = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        out = out & F.col(k).isNotNull()
    return out


def dedupe_last(src: DataFrame, key: str | list[str], order_by: str) -> DataFrame:
    """One row per key: the one with the largest ``order_by`` (a partial
    aggregate, so a hot key is combined map-side)."""
    keys = key_list(key)
    others = [c for c in src.columns if c not in keys]
    picked = src.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_by)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def key_problems(src: DataFrame, key: str | list[str]) -> DataFrame:
    """``(null_keys, duplicate_keys, rows)`` of a change set in one grouped
    pass (partial aggregation combines a hot key map-side)."""
    keys = key_list(key)
    per_key = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    whole = whole_key(keys)
    return per_key.agg(
        F.coalesce(F.sum(F.when(~whole, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(whole & (F.col("_n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
    )


def check_keys(src: DataFrame, key: str | list[str], allow_null: bool) -> int:
    """Raise on duplicate keys (and on null keys unless allowed); returns the row count."""
    row = key_problems(src, key).first()
    if row["duplicate_keys"]:
        raise ValueError(f"{row['duplicate_keys']} keys of {key!r} repeat in the source; pass order_by to keep the last")
    if row["null_keys"] and not allow_null:
        raise ValueError(f"{row['null_keys']} source rows have a null {key!r}")
    return int(row["rows"])


def _prepare(src: DataFrame, keys: list[str], order_by: str | None, validate: bool, allow_null: bool) -> DataFrame:
    if order_by:
        nulls = src.where(~whole_key(keys))
        src = dedupe_last(src.where(whole_key(keys)), keys, order_by).unionByName(nulls)
    if validate:
        check_keys(src, keys, allow_null)
    return src


def _blank(c, dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == F.lit(""))
    return c.isNull()


def _renamed(src: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    cols = [c for c in src.columns if c not in keys]
    out = src.where(whole_key(keys)).select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias(_MATCH))
    return out, cols


def _merged(target: DataFrame, src: DataFrame, keys: list[str], blanks: str, only_source: Column | None = None) -> list[Column]:
    """The target's columns with matching source values written over them, then
    the source's new ones."""
    if blanks not in ("keep", "overwrite"):
        raise ValueError("blanks must be 'keep' or 'overwrite'")
    types = {f.name: f.dataType for f in src.schema.fields}
    matched = F.coalesce(F.col(_MATCH), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys or c not in types:
            out.append(F.col(c))
            continue
        s = F.col(f"_s_{c}")
        take = matched & ~_blank(s, types[c]) if blanks == "keep" else matched
        if only_source is not None:
            take = only_source | take
        out.append(F.when(take, s).otherwise(F.col(c)).alias(c))
    return out + [F.col(f"_s_{c}").alias(c) for c in src.columns if c not in keys and c not in target.columns]


def _apply(target: DataFrame, src: DataFrame, keys: list[str], blanks: str) -> DataFrame:
    """Left join with the source as build side; target rows without a whole key
    go past it."""
    renamed, _ = _renamed(src, keys)
    updated = target.where(whole_key(keys)).join(renamed, keys, "left").select(*_merged(target, src, keys, blanks))
    return updated.unionByName(target.where(~whole_key(keys)), allowMissingColumns=True)


def update(target: DataFrame, src: DataFrame, key: str | list[str], blanks: str = "keep",
           order_by: str | None = None, validate: bool = True) -> DataFrame:
    """Overwrite-mode write: matching keys are updated; source keys not in the
    target change nothing (see ``write_outcomes``).  Null keys raise."""
    keys = key_list(key)
    return _apply(target, _prepare(src, keys, order_by, validate, allow_null=False), keys, blanks)


def upsert(target: DataFrame, src: DataFrame, key: str | list[str], blanks: str = "keep",
           order_by: str | None = None, validate: bool = True, plan: str = "build_source") -> DataFrame:
    """Update where the key exists, insert otherwise; target columns the
    source lacks are kept.  A key with a null is a plain insert.

    ``plan="build_source"`` keeps the change set on the build side of every
    join, so a small change set never shuffles the target.
    ``plan="full_outer"`` is one full outer join on the key: one shuffle per
    side (none when both sides are bucketed by the key), the better plan
    when the change set is itself large.  Spark splits no hot key in a full
    join, but only a key that repeats in the target can be hot in it."""
    keys = key_list(key)
    if plan not in ("build_source", "full_outer"):
        raise ValueError("plan must be 'build_source' or 'full_outer'")
    src = _prepare(src, keys, order_by, validate, allow_null=True)
    loose = src.where(~whole_key(keys))
    if plan == "full_outer":
        return _upsert_full_outer(target, src, keys, blanks).unionByName(loose, allowMissingColumns=True)
    keyed = src.where(whole_key(keys))
    # Keys of the source that the target holds: target keys (pruned columns)
    # semi-joined to the source keys, so the source is the build side.
    hits = target.select(*keys).join(keyed.select(*keys), keys, "left_semi")
    fresh = keyed.join(hits, keys, "left_anti")
    out = _apply(target, src, keys, blanks).unionByName(fresh, allowMissingColumns=True)
    return out.unionByName(loose, allowMissingColumns=True)


def _upsert_full_outer(target: DataFrame, src: DataFrame, keys: list[str], blanks: str) -> DataFrame:
    renamed, cols = _renamed(src, keys)
    marker = "_tessera_in_target"
    joined = target.where(whole_key(keys)).withColumn(marker, F.lit(True)).join(renamed, keys, "full")
    merged = joined.select(*_merged(target, src, keys, blanks, F.col(marker).isNull()))
    return merged.unionByName(target.where(~whole_key(keys)), allowMissingColumns=True)


def write_outcomes(target: DataFrame, src: DataFrame, key: str | list[str], operation: str) -> DataFrame:
    """Per source row, what the keyed write does with it:
    ``updated``, ``inserted``, ``not_found`` (update of a missing key),
    ``null_key`` or ``duplicate_key``."""
    if operation not in ("insert", "update", "upsert"):
        raise ValueError("operation must be insert, update or upsert")
    keys = key_list(key)
    keyed = src.where(whole_key(keys))
    # One row per key on the right, so a repeated key multiplies nothing.
    per_key = keyed.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("_dup"))
    hits = target.select(*keys).join(per_key.select(*keys), keys, "left_semi").distinct().withColumn("_hit", F.lit(True))
    marked = keyed.join(per_key.join(hits, keys, "left"), keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if operation == "insert":
        outcome = F.lit("inserted")
    else:
        missing = "not_found" if operation == "update" else "inserted"
        outcome = F.when(F.col("_dup"), F.lit("duplicate_key")).when(hit, F.lit("updated")).otherwise(F.lit(missing))
    keyed_out = marked.select(*src.columns, outcome.alias("outcome"))
    null_outcome = F.lit("inserted") if operation != "update" else F.lit("null_key")
    return keyed_out.unionByName(src.where(~whole_key(keys)).select(*src.columns, null_outcome.alias("outcome")))

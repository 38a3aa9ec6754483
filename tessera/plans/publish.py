"""Publish a DataFrame as a dataset: metadata, data files, commit.

A dataset folder holds data folders ``data/<id>/`` (Parquet, a new id for every
publish) and a commit log (``plans/commitlog.py``) with one row per commit:
version, data folder, schema, files it replaces.  Nothing is visible before its
version is committed, after all its files (Spark's output commit makes each file set
all-or-nothing).  Readers read the visible folders by path, each with the schema
recorded for it; no history is listed.

Operations: ``Overwrite`` starts a new base version, with its own columns;
``Append`` adds a version that readers union with the ones since the last base
(a column that only some versions have is null in the others; a column of another
type is refused); ``Upsert`` (which wins over the save mode and needs the
unique-id fields) merges the rows into the current content by key.

An upsert rewrites only the files that hold one of its keys, and its commit row
names them.  Datasets with unique ids are written in ranges of the key, and
``_bounds/<id>`` keeps each file's first and last key; files whose bounds meet none
of the change set's key ranges are left alone unread.  Of the rest the key columns
are semi-joined with the change set, so only files with a hit are merged; a handful of
files is merged without that search.

Writers do not share a version, and none is lost.  An Append commits whenever it is
ready.  Overwrite and Upsert settle all older versions first; an Upsert that finds a
commit it had not read merges again if that commit replaced one of the files it
rewrites, holds one of its keys, or was an Overwrite, and stands otherwise.  A writer
that was taken for failed publishes again under a new version.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.objects import check_keys, upsert as keyed_upsert, whole_key
from tessera.operators.profile import check_declared, metadata_json, read_metadata
from tessera.plans import commitlog
from tessera.plans.commitlog import MANIFEST, State, claim as _claim
from tessera.session import materialize

__all__ = ["MANIFEST", "dataset_operation", "publish", "read_dataset", "read_dataset_metadata", "read_manifest"]

# Fixed value: times an upsert merges again because others committed meanwhile.
MERGE_ATTEMPTS = 5
# Files that an upsert merges without looking which of them hold its keys.
FEW_FILES = 8
# Key ranges of a change set that are compared with the files' bounds.
KEY_RANGES = 64


def dataset_operation(mode: str | None, upsert: bool = False) -> str:
    """Upsert beats the save mode; Overwrite and Append by name; anything else appends."""
    if upsert:
        return "Upsert"
    if mode and mode.lower() == "overwrite":
        return "Overwrite"
    return "Append"


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed rows of the log, or None when nothing was ever committed at ``path``."""
    state = commitlog.open_log(spark, path)
    return state.manifest if state else None


def _log_state(spark: SparkSession, path: str) -> State | None:
    """The open log with the visible folders: a row per commit since the last Overwrite."""
    state = commitlog.open_log(spark, path)
    if state is not None:
        base = state.manifest.agg(F.max(F.when(F.col("operation") == "Overwrite", F.col("version")))).first()[0] or 0
        rows = state.manifest.where(F.col("version") >= F.lit(base)).select("version", "operation", "data", "schema", "removed")
        state.live = commitlog.live_folders(rows.collect())
    return state


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Current content: the files of the last base version and later commits that none of them replaced."""
    state = _log_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no committed dataset at {path}")
    return _read_files(spark, path, state)


def read_dataset_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Field table of the metadata published with the latest visible version."""
    state = _log_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no committed dataset at {path}")
    row = state.manifest.where(F.col("version") == F.lit(state.last)).first()
    return read_metadata(spark, f"{path}/_metadata/{row['data']}")


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _files(spark: SparkSession, path: str, folder: str, of: dict) -> list[str]:
    """Names of the visible files of a data folder."""
    found = spark.read.schema(_schema(of["schema"])).parquet(f"{path}/data/{folder}").inputFiles()
    return sorted(f"{folder}/{n}" for n in (f.rsplit("/", 1)[-1] for f in found) if n not in of["removed"])


def _read_files(spark: SparkSession, path: str, state: State, only: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The visible files (or ``only`` these) by path: one scan per distinct schema, missing columns null.

    ``columns`` prunes, and adds ``_tessera_file``: a hash of the folder and name of the row's file."""
    groups: dict[str, list[str]] = {}
    for folder, of in state.live.items():
        if only is not None:
            part = [f"{path}/data/{f}" for f in only if f.startswith(folder + "/")]
        elif of["removed"]:
            part = [f"{path}/data/{f}" for f in _files(spark, path, folder, of)]
        else:
            part = [f"{path}/data/{folder}"]
        groups.setdefault(of["schema"], []).extend(part)
    out = None
    for schema, paths in groups.items():
        rows = spark.read.schema(_schema(schema)).parquet(*paths) if paths else spark.createDataFrame([], _schema(schema))
        if columns is not None:
            if not paths or not set(columns) <= set(rows.columns):
                continue
            rows = rows.select(*columns, F.xxhash64(F.substring_index("_metadata.file_path", "/", -2)).alias("_tessera_file"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _type_conflicts(schema: T.StructType, state: State | None) -> list[str]:
    out = []
    for other in {of["schema"] for of in state.live.values()} if state else ():
        have = {f.name: f.dataType for f in _schema(other).fields}
        out += [
            f"column {f.name!r} is {have[f.name].simpleString()} in the dataset, not {f.dataType.simpleString()}"
            for f in schema.fields if f.name in have and have[f.name] != f.dataType
        ]
    return out


def _write_bounds(spark: SparkSession, path: str, folder: str, schema: T.StructType, keys: list[str]) -> None:
    """First and last key of each file; only the key's first column is read."""
    rows = spark.read.schema(schema).parquet(f"{path}/data/{folder}")
    if len(rows.inputFiles()) > FEW_FILES:
        k = F.col(f"`{keys[0]}`")
        rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(k).alias("lo"), F.max(k).alias("hi")).coalesce(1).write.parquet(f"{path}/_bounds/{folder}/key={keys[0]}")


def _within_bounds(spark: SparkSession, path: str, state: State, changes: DataFrame, keys: list[str]) -> list[str]:
    """The visible files that may hold a key of ``changes``, by their bounds; a file without bounds may."""
    k = F.col(f"`{keys[0]}`")
    ranges = changes.where(whole_key(keys)).select(k.alias("k")).repartitionByRange(KEY_RANGES, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("from"), F.max("k").alias("to"))
    bounded, out = [], []
    for folder, of in state.live.items():
        names = _files(spark, path, folder, of)
        has = commitlog._names(spark, f"{path}/_bounds/{folder}") if len(names) > 1 else []
        if f"key={keys[0]}" in [n for n, _ in has] and _schema(of["schema"])[keys[0]].dataType == changes.schema[keys[0]].dataType:
            bounded.append((folder, set(names)))
        else:
            out += names
    if bounded:
        read = None
        for folder, _ in bounded:
            part = spark.read.parquet(f"{path}/_bounds/{folder}/key={keys[0]}").select(F.lit(folder).alias("folder"), "file", "lo", "hi")
            read = part if read is None else read.unionAll(part)
        near = read.join(F.broadcast(ranges), (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")), "left_semi")  # KEY_RANGES rows at most
        visible = dict(bounded)
        out += [n for r in near.collect() if (n := f"{r['folder']}/{r['file']}") in visible[r["folder"]]]
    return sorted(out)


def _holding(spark: SparkSession, path: str, state: State, files: list[str], changes: DataFrame, keys: list[str]) -> list[str]:
    """Those of the files that hold a key of ``changes``: a semi join that reads only key columns."""
    held = _read_files(spark, path, state, only=files, columns=keys)
    if held is None:
        return []
    hit = held.where(whole_key(keys)).join(changes.where(whole_key(keys)).select(*keys), keys, "left_semi")
    named = spark.createDataFrame([(f,) for f in files], "name string").withColumn("_tessera_file", F.xxhash64("name"))
    return sorted(r["name"] for r in named.join(hit.select("_tessera_file").distinct(), "_tessera_file", "left_semi").collect())  # a name per file to rewrite


def _touched(spark: SparkSession, path: str, state: State, changes: DataFrame, keys: list[str]) -> list[str]:
    files = _within_bounds(spark, path, state, changes, keys)
    return files if len(files) <= FEW_FILES else _holding(spark, path, state, files, changes, keys)


def _conflicts(spark: SparkSession, path: str, newer: set[int], removed: list[str], changes: DataFrame, keys: list[str]) -> bool:
    """Whether one of these commits changed what the upsert read."""
    state = _log_state(spark, path)
    rows = state.manifest.where(F.col("version").isin(sorted(newer))).collect()
    if any(r["operation"] == "Overwrite" or set(r["removed"] or []) & set(removed) for r in rows):
        return True
    state.live = {f: of for f, of in state.live.items() if of["version"] in newer}
    files = _within_bounds(spark, path, state, changes, keys)
    return bool(files) and bool(_holding(spark, path, state, files, changes, keys))


def publish(
    df: DataFrame,
    path: str,
    mode: str = "append",
    upsert: bool = False,
    unique_ids: list[str] | None = None,
    dataset: str | None = None,
    type_map: str | dict | None = None,
    metadata_path: str | None = None,
    epoch: int | None = None,
    stream: str | None = None,
    lease: float = commitlog.LEASE_SECONDS,
) -> DataFrame:
    """Write ``df`` to the dataset at ``path`` and commit; returns the commit row
    (``rows``: the rows that it wrote, for an upsert those of the rewritten files).

    ``stream`` and ``epoch`` make a publish idempotent: an epoch that this
    stream already committed is not written again (used by the streaming sink).
    With ``unique_ids`` the files are ranges of the key, which later upserts by
    the same key prune.  ``lease``: seconds after which another writer's claim
    without a commit counts as failed."""
    spark = df.sparkSession
    operation = dataset_operation(mode, upsert)
    if operation == "Upsert" and not unique_ids:
        raise ValueError("upsert needs the unique-id fields (unique_ids)")
    name = dataset or path.rstrip("/").rsplit("/", 1)[-1]
    if metadata_path:
        read_metadata(spark, metadata_path).first()  # fails early on a bad document
    else:
        check_declared(df.schema, type_map)
    state = _log_state(spark, path)
    if epoch is not None and state is not None:
        same = state.manifest.where((F.col("epoch") == F.lit(epoch)) & F.col("stream").eqNullSafe(F.lit(stream)))
        if not same.isEmpty():
            return same
    if operation == "Upsert":
        # Checked, searched for and merged: its plan runs once, the rest reads what it wrote.
        df = materialize(df, "changes")
        # Also before the first version, which later upserts merge into by these keys.
        check_keys(df, unique_ids, allow_null=True)
    folder = None
    for _ in range(MERGE_ATTEMPTS):
        if folder is None:
            data, removed = df, []
            if operation == "Append" and (wrong := _type_conflicts(_nullable(df.schema), state)):
                raise ValueError(wrong[0])
            if operation == "Upsert" and state is not None:
                removed = _touched(spark, path, state, df, unique_ids)
                if _type_conflicts(_nullable(df.schema), state):  # the merge settles the types, so all files take part
                    removed = [f for folder_, of in state.live.items() for f in _files(spark, path, folder_, of)]
                if removed:
                    # Joined once: the bounds of the key ranges below are found by a pass of their own.
                    data = materialize(keyed_upsert(_read_files(spark, path, state, only=removed), df, unique_ids, blanks="overwrite", validate=False), "merged")
            folder = uuid.uuid4().hex
            # Metadata first: the supplied document as given, else the one derived
            # from the schema and the type map (one small JSON file per version).
            if metadata_path:
                doc = spark.read.text(metadata_path, wholetext=True)
            else:
                doc = spark.createDataFrame([(metadata_json(data.schema, name, type_map, unique_ids),)], "value string")
            doc.coalesce(1).write.text(f"{path}/_metadata/{folder}")
            # One evaluation: the rows are counted while they are written, and
            # files are as large as Spark's advisory partition size makes them.
            seen = Observation()
            sized = data.repartitionByRange(*[F.col(f"`{k}`") for k in unique_ids]) if unique_ids else data.hint("rebalance")
            sized.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/data/{folder}")
            if unique_ids:
                _write_bounds(spark, path, folder, data.schema, unique_ids)
        version = (state.top if state else 0) + 1
        while not _claim(spark, path, version):
            version += 1
        commit = commitlog.write_row(spark, path, (
            version, operation, "Completed", int(seen.get["rows"]), folder, json.dumps(_nullable(data.schema).jsonValue()),
            stream, epoch, _dt.datetime.now(_dt.timezone.utc).isoformat(), removed,
        ))
        if operation != "Append":
            newer = commitlog.settle_older(spark, path, version, state, lease)
            if operation == "Upsert" and newer and _conflicts(spark, path, newer, removed, df, unique_ids):
                commitlog.settle(spark, path, version, "dead")
                state, folder = _log_state(spark, path), None
                continue  # merged into content that is no longer the last
        if commitlog.settle(spark, path, version, "done"):
            commitlog.checkpoint_if_due(spark, path, version)
            return commit
        # Taken for failed: the rows are published again under a new version.
        state = _log_state(spark, path)
        if operation == "Upsert":
            folder = None
    raise RuntimeError(f"{path}: other writers committed during each of {MERGE_ATTEMPTS} merges")

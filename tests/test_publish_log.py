"""Commits of several writers, upserts that rewrite few files, long logs."""

import random
import threading

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tessera.plans import commitlog
from tessera.plans.publish import _log_state, publish, read_dataset, read_manifest
from tessera.session import scratch_path


def nation(spark, add=0):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    return n.withColumn("n_nationkey", F.col("n_nationkey") + add)


def three(spark):
    return nation(spark).where("n_nationkey = 3").withColumn("n_name", F.lit("three"))


@pytest.mark.parametrize("lease", [600.0, 0.0], ids=["waits", "takes it for failed"])
@pytest.mark.parametrize("operation", ["Upsert", "Overwrite"])
def test_an_append_in_flight_is_not_lost(spark, monkeypatch, lease, operation):
    """Another writer commits between an append's claim and its commit row."""
    path = scratch_path(spark, "log-flight")
    publish(nation(spark), path, mode="overwrite")
    write_row, begun = commitlog.write_row, []

    def other():
        if operation == "Upsert":
            publish(three(spark), path, upsert=True, unique_ids=["n_nationkey"], lease=lease)
        else:
            publish(nation(spark, 200), path, mode="overwrite", lease=lease)

    def late(s, p, row):
        if not begun and row[1] == "Append":
            begun.append(threading.Thread(target=other))
            begun[0].start()
            begun[0].join(3.0 if lease else 120.0)
            assert begun[0].is_alive() == bool(lease)  # it waits for this claim, or has discarded it
        return write_row(s, p, row)

    monkeypatch.setattr(commitlog, "write_row", late)
    publish(nation(spark, 100), path, mode="append")
    begun[0].join(120)
    back = read_dataset(spark, path)
    versions = [r["version"] for r in read_manifest(spark, path).collect()]
    assert len(versions) == len(set(versions)) == 3
    if operation == "Upsert":
        assert back.count() == 50 and back.where("n_nationkey >= 100").count() == 25 and back.where("n_name = 'three'").count() == 1
    elif lease:  # the append came first, the overwrite replaced it
        assert back.count() == 25 and back.where("n_nationkey >= 200").count() == 25
    else:  # the append was published again, after the overwrite
        assert back.count() == 50


def test_an_upsert_in_flight_keeps_an_append_that_came_later(spark, monkeypatch):
    path = scratch_path(spark, "log-later")
    publish(nation(spark), path, mode="overwrite")
    write_row, begun = commitlog.write_row, []

    def late(s, p, row):
        if not begun and row[1] == "Upsert":
            begun.append(1)
            publish(nation(spark, 100), path, mode="append")
        return write_row(s, p, row)

    monkeypatch.setattr(commitlog, "write_row", late)
    publish(three(spark), path, upsert=True, unique_ids=["n_nationkey"])
    back = read_dataset(spark, path)
    assert back.count() == 50 and back.where("n_name = 'three'").count() == 1


@pytest.mark.parametrize("add, again", [(0, True), (100, False)], ids=["same keys", "other keys"])
def test_an_upsert_merges_again_only_for_its_own_keys(spark, monkeypatch, add, again):
    """An append commits after the upsert has read and before it claims."""
    from tessera.plans import publish as pub

    path = scratch_path(spark, "log-again")
    publish(nation(spark), path, mode="overwrite")
    claim, merged, raced = pub._claim, [], []
    merge = pub.keyed_upsert
    monkeypatch.setattr(pub, "keyed_upsert", lambda *a, **k: merged.append(1) or merge(*a, **k))

    def late(s, p, version):
        if not raced:
            raced.append(1)
            publish(nation(spark, add), path, mode="append")
        return claim(s, p, version)

    monkeypatch.setattr(pub, "_claim", late)
    publish(three(spark), path, upsert=True, unique_ids=["n_nationkey"])
    back = read_dataset(spark, path)
    assert back.count() == 50 and len(merged) == 1 + again
    assert back.where("n_name = 'three'").count() == (2 if again else 1)


@pytest.fixture
def many_files(spark):
    """A dataset in 40 key ranges, whatever its size."""
    names = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ["false", "40"], strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("keys", [["o_orderkey"], ["o_orderkey", "o_custkey"]])
def test_an_upsert_of_one_percent_rewrites_few_files(spark, many_files, keys):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "log-pruned")
    publish(orders, path, mode="overwrite", unique_ids=keys)
    first = _log_state(spark, path)
    n_files = len(read_dataset(spark, path).inputFiles())
    low, high = orders.agg(F.expr("percentile_approx(o_orderkey, 0.5, 10000)"), F.expr("percentile_approx(o_orderkey, 0.51, 10000)")).first()
    changes = orders.where(F.col("o_orderkey").between(low, high)).withColumn("o_totalprice", F.lit(-1.0).cast(orders.schema["o_totalprice"].dataType))
    commit = publish(changes, path, upsert=True, unique_ids=keys).first()
    assert n_files >= 30 and 1 <= len(commit["removed"]) <= 3
    assert commit["rows"] < 0.1 * orders.count()
    back = read_dataset(spark, path)
    assert bag(back) == bag(orders.join(changes, keys, "left_anti").select(orders.columns).unionAll(changes.select(orders.columns)))
    text = back._jdf.queryExecution().toString()
    assert not any(f in text for f in commit["removed"]) and len(first.live) == 1
    # New keys only: nothing is rewritten, and null keys are inserted.
    fresh = changes.withColumn("o_orderkey", -F.col("o_orderkey")).limit(5).unionAll(changes.withColumn("o_orderkey", F.lit(None).cast(orders.schema["o_orderkey"].dataType)).limit(2))
    before = back.count()
    assert publish(fresh, path, upsert=True, unique_ids=keys).first()["rows"] < 0.2 * before
    assert read_dataset(spark, path).count() == before + fresh.count()


def test_an_upsert_evaluates_its_rows_once(spark, many_files):
    """The change set is checked, searched for and merged, but its plan runs once."""
    seen = spark.sparkContext.accumulator(0)

    def status(k):
        seen.add(1)
        return f"new {k}"

    path = scratch_path(spark, "log-once")
    rows = spark.range(3000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    publish(rows, path, mode="overwrite", unique_ids=["k"])
    changes = spark.range(0, 6000, 3).select(F.col("id").alias("k"), F.udf(status)("id").alias("v"))
    commit = publish(changes, path, upsert=True, unique_ids=["k"]).first()
    assert seen.value == 2000 and len(commit["removed"]) > 8
    assert bag(read_dataset(spark, path)) == sorted([(k, "old" if k % 3 else f"new {k}") for k in range(3000)] + [(k, f"new {k}") for k in range(3000, 6000, 3)], key=repr)


def test_an_upsert_of_scattered_keys_finds_their_files(spark, many_files):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "log-scattered")
    publish(orders.repartition(40), path, mode="overwrite")  # hashed: no bounds, every file may hold a key
    keys = [r[0] for r in orders.orderBy(F.xxhash64("o_orderkey")).limit(12).collect()]
    changes = orders.where(F.col("o_orderkey").isin(keys)).withColumn("o_orderstatus", F.lit("new"))
    state = _log_state(spark, path)
    touched = len(_holding_files(spark, path, state, keys))
    commit = publish(changes, path, upsert=True, unique_ids=["o_orderkey"]).first()
    assert len(commit["removed"]) == touched or touched <= 8
    back = read_dataset(spark, path)
    assert back.count() == orders.count() and back.where("o_orderstatus = 'new'").count() == 12


def _holding_files(spark, path, state, keys):
    return {r[0] for r in read_dataset(spark, path).where(F.col("o_orderkey").isin(keys)).select("_metadata.file_path").distinct().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_commits_against_a_model(spark, many_files, seed):
    rng, path, model = random.Random(seed), scratch_path(spark, "log-model"), None
    for step in range(10):
        rows = [(k, f"{step}-{k}") for k in rng.sample(range(60), rng.randrange(1, 30))]
        df = spark.createDataFrame(rows, "k long, v string")
        kind = rng.choice(["append", "overwrite", "upsert", "upsert", "upsert"]) if model is not None else "overwrite"
        if kind == "upsert":
            publish(df, path, upsert=True, unique_ids=["k"])
            new = dict(rows)
            have = {k for k, _ in model}
            model = [(k, new.get(k, v)) for k, v in model] + [r for r in rows if r[0] not in have]
        else:
            publish(df, path, mode=kind, unique_ids=["k"] if rng.random() < 0.5 else None)
            model = rows if kind == "overwrite" else model + rows
        assert bag(read_dataset(spark, path).select("k", "v")) == sorted(model, key=repr)


def test_an_upsert_brings_a_new_column_and_another_type(spark, many_files):
    path = scratch_path(spark, "log-columns")
    publish(spark.createDataFrame([(k, k, "a") for k in range(100)], "k long, n int, v string"), path, mode="overwrite", unique_ids=["k"])
    publish(spark.createDataFrame([(1, "b", "x")], "k long, v string, w string"), path, upsert=True, unique_ids=["k"])
    back = read_dataset(spark, path)
    assert back.columns == ["k", "n", "v", "w"] and bag(back.where("w is not null")) == [(1, 1, "b", "x")]
    publish(spark.createDataFrame([(2, 1 << 40, "c")], "k long, n long, v string"), path, upsert=True, unique_ids=["k"])
    back = read_dataset(spark, path)
    assert dict(back.dtypes)["n"] == "bigint" and back.count() == 100 and back.where("k = 2").first()["n"] == 1 << 40


def test_a_log_of_ten_thousand_commits_opens_by_one_checkpoint(spark, monkeypatch):
    path = scratch_path(spark, "log-long")
    publish(nation(spark), path, mode="overwrite")
    row = read_manifest(spark, path)
    old = spark.range(2, 10_001).withColumnRenamed("id", "version").crossJoin(row.drop("version", "operation")).withColumn("operation", F.lit("Upsert"))
    old = old.withColumn("data", F.concat(F.lit("gone"), "version")).withColumn("removed", F.array(F.concat(F.lit("gone"), F.col("version") - 1, F.lit("/*"))))
    commitlog.write_checkpoint(row.unionByName(old.select(row.columns)), path, 10_000)
    listed = []
    names = commitlog._names
    monkeypatch.setattr(commitlog, "_names", lambda s, p: listed.append(p) or names(s, p))
    commit = publish(nation(spark, 100), path, mode="append").first()
    assert commit["version"] == 10_001
    state = _log_state(spark, path)
    assert state.checkpoint == 10_000 and state.seen == {10_001} and len(state.live) == 3 and state.manifest.count() == 10_001
    assert len(state.manifest.inputFiles()) == 2 and len(set(listed)) <= 4


def test_checkpoints_come_with_commits(spark, monkeypatch):
    monkeypatch.setattr(commitlog, "GROUP", 3)
    path = scratch_path(spark, "log-group")
    for k in range(7):
        publish(nation(spark, 100 * k), path, mode="append", epoch=k, stream="s")
    state = _log_state(spark, path)
    assert state.checkpoint == 6 and state.last == 7 and read_dataset(spark, path).count() == 175
    assert publish(nation(spark), path, mode="append", epoch=2, stream="s").first()["version"] == 3  # known from the checkpoint
    assert read_dataset(spark, path).count() == 175


def test_claims_are_settled_once(spark):
    path = scratch_path(spark, "log-claims")
    assert commitlog.claim(spark, path, 5) and not commitlog.claim(spark, path, 5)
    assert commitlog.settle(spark, path, 5, "done") and not commitlog.settle(spark, path, 5, "dead")
    assert not commitlog.claim(spark, path, 5)  # also after the rename
    assert commitlog.claims(spark, path)[5][0] == "done" and not commitlog.settle(spark, path, 6, "done")

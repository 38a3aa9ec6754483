import importlib
import shutil

from tests.conftest import SF
from tessera.catalog import QUERIES


def test_entry_and_registry(spark):
    entry = importlib.import_module("__spark_entry__")
    out = entry.entry(spark)
    assert out.columns == ["event_type", "user_id", "count"] and out.count() > 0
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    own = set(QUERIES)
    assert own <= set(qs) and own <= set(oracles)


def test_streaming_publish(spark):
    from tessera.plans.publish import read_dataset
    from tessera.session import scratch_path
    from tessera.streaming.sink import publish_stream

    nation = spark.read.parquet(f"{SF}/nation.parquet")
    folder = scratch_path(spark, "stream-src")
    nation.write.parquet(folder)
    stream = spark.readStream.schema(nation.schema).parquet(folder)
    path = scratch_path(spark, "stream-pub")
    q = publish_stream(stream, path, scratch_path(spark, "stream-ckpt"), mode="append", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert read_dataset(spark, path).count() == 25


def test_stream_batches(spark):
    from pyspark.sql import functions as F

    from tessera.session import scratch_path
    from tessera.sources.bulk import log_batches, write_batches
    from tessera.streaming.source import stream_batches

    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    path, out, checkpoint = (scratch_path(spark, x) for x in ("stream-batches", "stream-out", "stream-ckpt"))
    manifest = write_batches(conv, path, ["conv_id", "turn"], max_bytes=100_000)
    assert manifest.count() > 1

    def run():
        q = stream_batches(spark, path, conv.schema, out, checkpoint, max_chars=-1, newline=None, trigger={"availableNow": True})
        q.awaitTermination(180)
        assert q.exception() is None
        return spark.read.parquet(out).drop("stream", "epoch")

    # One batch is not ready: its files are there, its Completed row is not.
    rows = [r.asDict() for r in manifest.collect()]
    held = scratch_path(spark, "stream-held")
    local = lambda p: p.removeprefix("file:").replace("///", "/")
    shutil.copytree(local(path), local(held), ignore=shutil.ignore_patterns("_manifest"))
    path = held
    first = rows[0]["batch_id"]
    frame = lambda rs: spark.createDataFrame(rs, manifest.schema)
    log_batches(frame([{**r, "state": "InProgress" if r["batch_id"] == first else r["state"]} for r in rows]), held)
    want = sum(r["rows"] for r in rows if r["batch_id"] != first)
    assert run().count() == want
    log_batches(frame([r for r in rows if r["batch_id"] == first]), held)
    log_batches(frame(rows), held)  # listed again: not read again
    back = run()
    assert back.count() == conv.count() and back.exceptAll(conv).count() == 0
    assert back.agg(F.count_distinct("conv_id")).first()[0] == conv.select("conv_id").distinct().count()


def test_streams_to_one_table_do_not_overwrite_each_other(spark):
    from tessera.plans.publish import read_dataset
    from tessera.session import scratch_path
    from tessera.streaming.sink import append_stream, publish_stream

    nation = spark.read.parquet(f"{SF}/nation.parquet")
    folder = scratch_path(spark, "stream-src-two")
    nation.write.parquet(folder)
    table, dataset = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-dataset")
    for _ in range(2):  # a second stream, with a checkpoint of its own
        for start, target in ((append_stream, table), (publish_stream, dataset)):
            q = start(spark.readStream.schema(nation.schema).parquet(folder), target, scratch_path(spark, "ckpt-two"), trigger={"availableNow": True})
            q.awaitTermination(120)
            assert q.exception() is None
    assert spark.read.parquet(table).count() == 50 and read_dataset(spark, dataset).count() == 50


def test_streaming_publish_many_epochs(spark):
    from tessera.plans.publish import read_dataset, read_manifest
    from tessera.session import scratch_path
    from tessera.streaming.sink import publish_stream

    nation = spark.read.parquet(f"{SF}/nation.parquet")
    folder = scratch_path(spark, "stream-src-many")
    nation.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(nation.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    path = scratch_path(spark, "stream-pub-many")
    q = publish_stream(stream, path, scratch_path(spark, "stream-ckpt-many"), trigger={"availableNow": True})
    q.awaitTermination(300)
    back = read_dataset(spark, path)
    assert back.exceptAll(nation).count() == 0 and nation.exceptAll(back).count() == 0
    assert read_manifest(spark, path).count() >= 5  # one commit per micro-batch


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="group_count,csv_lines")
    out = subprocess.run([sys.executable, str(root / "bench.py")], cwd=root, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"group_count", "csv_lines"} and not d["errors"]
    assert d["value"] == round(sum(d["queries"].values()), 3) and d["sf"] == 0.001

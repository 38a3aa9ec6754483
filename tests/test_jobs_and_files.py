"""Job states over time, batch and stream, and inference kept up over added files."""

import datetime as dt
import os
import random
import time

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tessera.functions.lenient import Lenient
from tessera.operators.infer import infer_types
from tessera.operators.infer_files import infer_added_files
from tessera.operators.jobs import job_outcomes, job_states
from tessera.session import scratch_path
from tessera.streaming.jobs import job_outcome_stream

T0 = dt.datetime(2024, 1, 1)
LOG = "job_id long, status string, at timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_the_last_state_wins_and_old_pending_jobs_time_out(spark):
    rows = [
        (1, "New", at(0)), (1, "InProgress", at(5)), (1, "Completed", at(9)), (2, "Completed", at(3)), (2, "Failed", at(4)), (3, "New", at(0)), (3, "InProgress", at(100)),
        (4, "Queued", at(90)), (5, "Failed", at(7)), (5, "Completed", at(7)), (6, "Odd", at(0)),
    ]
    log = spark.createDataFrame(rows, LOG)
    got = {r["job_id"]: (r["status"], r["outcome"]) for r in job_states(log.repartition(5), "2024-01-01 02:00:00", "1 hour").collect()}
    assert got == {1: ("Completed", "success"), 2: ("Failed", "failure"), 3: ("InProgress", "timed_out"), 4: ("Queued", "pending"), 5: ("Failed", "failure"), 6: ("Odd", "success")}
    assert job_states(log.where("false"), "2024-01-01 02:00:00", "1 hour").count() == 0
    assert job_outcomes(log, log.select("job_id").distinct()).count() == 6  # one row a job


def run_stream(spark, batches, timeout, watermark):
    src, out, ckpt = (scratch_path(spark, x) for x in ("job-log", "job-out", "job-ckpt"))
    results = []
    empty = spark.createDataFrame([], LOG)
    empty.write.parquet(src)
    for rows in batches:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(empty.schema).parquet(src)
        q = job_outcome_stream(stream, timeout, watermark).writeStream.outputMode("update").option("checkpointLocation", ckpt).foreachBatch(lambda df, _: results.extend(map(tuple, df.collect())))
        q = q.trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    return results


def test_a_stream_of_states(spark):
    batches = [
        [(1, "New", at(0)), (2, "New", at(0)), (3, "Queued", at(1))],
        [(1, "Completed", at(9)), (2, "InProgress", at(8)), (4, "New", at(10))],
        [(2, "New", at(7)), (1, "InProgress", at(8))],  # older than what is known: nothing changes
        [(2, "Failed", at(30)), (5, "Completed", at(31))],
        [(9, "New", at(200))],  # the watermark passes the timeout of 3 and 4
        [(3, "Completed", at(20))],  # later than the watermark: dropped
        [(10, "New", at(201))],
    ]
    got = run_stream(spark, batches, timeout=3600, watermark="10 minutes")
    out = [(r[0], r[1], r[4]) for r in got]
    assert sorted(out) == [(1, "Completed", "success"), (2, "Failed", "failure"), (3, "Queued", "timed_out"), (4, "New", "timed_out"), (5, "Completed", "success")]
    by_job = {r[0]: r for r in got}
    assert by_job[2][2] == at(0) and by_job[2][3] == at(30) and by_job[3][2] == at(1)


def test_the_stream_agrees_with_the_batch(spark):
    rng = random.Random(3)
    names = ["New", "Queued", "InProgress", "Failed", "Completed"]
    rows = [(rng.randrange(40), rng.choice(names), at(rng.randrange(60))) for _ in range(300)]
    got = run_stream(spark, [rows[k::3] for k in range(3)] + [[(-1, "Completed", at(5000))], [(-2, "Completed", at(5001))]], timeout=7200, watermark="2 hours")
    last = {}
    for r in got:
        last[r[0]] = (r[1], r[4])
    batch = {r["job_id"]: (r["status"], r["outcome"]) for r in job_states(spark.createDataFrame(rows, LOG), "2024-02-01 00:00:00", "2 hours").collect()}
    assert {k: v for k, v in last.items() if k >= 0} == batch


def types(df):
    return [(r["position"], r["column"], r["type"]) for r in df.orderBy("position").collect()]


@pytest.mark.parametrize("pattern", [None, "yyyy-MM-dd HH:mm:ss", Lenient("yyyy-MM-dd")])
def test_incremental_inference_equals_a_full_pass(spark, tmp_path, pattern):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(*[F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")])
    o = o.withColumn("late", F.when(F.col("o_orderkey").cast("long") % 3 == 2, F.lit("3000000000")).otherwise(F.lit("5")))
    path, states = str(tmp_path / "files"), scratch_path(spark, "infer-states")
    seen = []
    for k in range(3):
        part = o.where(F.col("o_orderkey").cast("long") % 3 == k)
        part.repartition(2).write.mode("append").option("header", "true").csv(path)
        got, new = infer_added_files(spark, path, states, o.columns, pattern, header="true")
        assert len(new) == 2 and not set(new) & set(seen)  # only what was added is read
        seen += new
        there = spark.read.schema(o.schema).option("header", "true").csv(path)
        assert types(got) == types(infer_types(there, o.columns, pattern))
    got, new = infer_added_files(spark, path, states, o.columns, pattern, header="true")
    assert new == [] and dict((c, t) for _, c, t in types(got))["late"] == "long"
    # A file that is gone no longer counts; one that changed is read again.
    files = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    os.remove(f"{path}/{files[0]}")
    time.sleep(0.05)
    os.remove(f"{path}/.{files[1]}.crc")
    with open(f"{path}/{files[1]}", "a") as f:
        f.write("x,x,x,x,x\n")
    got, new = infer_added_files(spark, path, states, o.columns, pattern, header="true")
    assert len(new) == 1 and types(got) == types(infer_types(spark.read.schema(o.schema).option("header", "true").csv(path), o.columns, pattern))


def test_incremental_inference_of_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    states = scratch_path(spark, "infer-empty")
    got, new = infer_added_files(spark, str(tmp_path), states, ["a", "b"], header="true")
    assert types(got) == [(0, "a", "string"), (1, "b", "string")] and len(new) == 1
    assert infer_added_files(spark, str(tmp_path), states, ["a", "b"], header="true")[1] == []

from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.operators.parts import (estimated_size, part_manifest, part_payloads, parted_lines, size_partitions,
                                     size_plan, write_parts)
from tessera.session import scratch_path


def wide_rows(spark, n):
    """Rows of different widths, from the events table."""
    ev = spark.read.parquet(f"{SF}/events.parquet").orderBy("event_id").limit(n)
    return ev.select("event_id", F.repeat(F.col("event_type"), (F.col("user_id") % 5 + 1).cast("int")).alias("label"), "props")


def test_small_frames_give_one_partition(spark):
    assert size_partitions(wide_rows(spark, 1500).repartition(4)).rdd.getNumPartitions() == 1
    assert size_partitions(wide_rows(spark, 1500).repartition(4), current=4).rdd.getNumPartitions() == 1


def test_size_grows_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    plan = size_plan(docs, 500_000).first()
    assert plan["parts"] == plan["bytes"] // 500_000 + 1
    assert size_partitions(docs, 500_000).rdd.getNumPartitions() == plan["parts"]


def test_estimate_close_to_exact(spark):
    df = wide_rows(spark, 1234)
    exact = size_plan(df).first()["bytes"]
    est = estimated_size(df)
    assert 0.5 * exact < est < 1.5 * exact
    small = wide_rows(spark, 5)
    assert estimated_size(small) == size_plan(small).first()["bytes"]


def test_payloads_hold_every_row_once(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    pay = part_payloads(o, ["o_orderkey"], max_bytes=200_000, header=True)
    rows = pay.agg(F.sum("rows")).first()[0]
    assert rows == 15000
    first = pay.orderBy("part_number").first()["payload"].split("\n")
    assert first[0] == ",".join(o.columns) and first[1].startswith("0,")
    man = part_manifest(o, ["o_orderkey"], max_bytes=200_000)
    assert man.agg(F.max("bytes")).first()[0] <= 200_000 + 200  # a part ends with the line that passes the limit


def test_write_parts_round_trip(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    path = scratch_path(spark, "parts-test")
    man = write_parts(o, path, ["o_orderkey"], max_bytes=300_000)
    back = spark.read.text(path)
    assert back.count() == 15000 == man.agg(F.sum("rows")).first()[0]


def test_write_parts_counts_records_with_newlines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "parts-docs")
    man = write_parts(docs, path, ["doc_id"], max_bytes=400_000)
    assert man.agg(F.sum("rows")).first()[0] == 1000
    exact = size_plan(docs).first()["bytes"]
    assert man.agg(F.sum("bytes")).first()[0] == exact


def test_write_parts_range_split(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "parts-range")
    man = write_parts(docs, path, ["doc_id"], max_bytes=400_000, split="range")
    assert man.agg(F.sum("rows")).first()[0] == 1000
    assert man.agg(F.sum("bytes")).first()[0] == size_plan(docs).first()["bytes"]


def test_share_is_exact_at_scale(spark):
    from tessera.operators.parts import share

    rows = 10**12 + 7
    hard = ((rows - 1) * pow(7, -1, rows)) % rows  # pos * 7 leaves remainder rows - 1
    cases = [(hard, 7), (hard - 1, 7), (10**12, 10**7), (123_456_789_012, 7_777_777), (0, 3)]
    df = spark.createDataFrame(cases, "pos long, parts long").withColumn("rows", F.lit(rows).cast("long"))
    got = df.select("pos", "parts", share(F.col("pos"), F.col("parts"), F.col("rows")).alias("s")).collect()
    assert all(r["s"] == r["pos"] * r["parts"] // rows for r in got)


def test_write_parts_acknowledged(spark):
    from tessera.operators.parts import acknowledge, landed_bytes, parts_ok

    o = spark.read.parquet(f"{SF}/orders.parquet")
    path = scratch_path(spark, "parts-ack")
    man = write_parts(o, path, ["o_orderkey"], max_bytes=150_000)
    rows = man.collect()
    assert all(r["ok"] for r in rows) and sum(r["rows"] for r in rows) == 15000
    assert parts_ok(man).first()["ok"] is True
    # A part that lost bytes, or a missing part, fails the check.
    plan, landed = man.select("part_number", "rows", "bytes"), landed_bytes(spark, path, ["part_number"])
    short = landed.withColumn("landed", F.when(F.col("part_number") == 1, F.col("landed") - 1).otherwise(F.col("landed")))
    assert parts_ok(acknowledge(plan, short)).first()["ok"] is False
    assert parts_ok(acknowledge(plan, landed.where("part_number <> 2"))).first()["ok"] is False
    assert parts_ok(man.where("part_number <> 2")).first()["ok"] is False


def test_parts_are_bounded_by_bytes_not_rows(spark):
    # One row in twenty is 100 KB; a part is at most the limit plus one line.
    df = spark.range(1000).select("id", F.when(F.col("id") % 20 == 7, F.repeat(F.lit("x"), 100_000)).otherwise(F.lit("y")).alias("v"))
    for split in ("exact", "range"):
        lines = parted_lines(df, ["id"], max_bytes=500_000, split=split)
        sizes = lines.groupBy("part_number").agg(F.sum("bytes").alias("b"), F.max("bytes").alias("line")).collect()
        assert all(r["b"] < 500_000 + r["line"] for r in sizes)
        assert sorted(r["part_number"] for r in sizes) == list(range(1, len(sizes) + 1))
    # Lines longer than a part: one each, numbered without gaps.
    sizes = part_manifest(df.where("id % 20 = 7"), ["id"], max_bytes=30_000).collect()
    assert sorted(r["part_number"] for r in sizes) == list(range(1, 51)) and {r["rows"] for r in sizes} == {1}


def test_default_target_gives_two_partitions_for_10_to_20_mb(spark):
    o = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")
    twice = o.unionByName(o)  # about 15.8 MB of CSV text
    plan = size_plan(twice).first()
    assert 10 * 1024 * 1024 < plan["bytes"] < 20 * 1024 * 1024 and plan["parts"] == 2
    assert size_partitions(twice).rdd.getNumPartitions() == 2
    assert size_partitions(o).rdd.getNumPartitions() == 1


def test_a_manifest_moves_no_text_and_has_the_parts_of_the_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("k", F.col("doc_id") % 7)  # many rows of one key
    for split in ("exact", "range"):
        light = parted_lines(docs, ["k"], 50_000, split=split, with_line=False)
        whole = parted_lines(docs, ["k"], 50_000, split=split)
        assert "line" not in light.columns and "line" not in light._jdf.queryExecution().analyzed().toString()
        sizes = lambda x: sorted(map(tuple, x.groupBy("part_number").agg(F.count("*"), F.sum("bytes")).collect()))
        if split == "exact":
            assert sizes(light) == sizes(whole)
        assert light.count() == whole.count() == 1000

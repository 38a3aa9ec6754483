"""Lenient timestamps, samples with replacement, header bounds, batches by run and state."""

import datetime as dt

import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.casting import cast_value
from tessera.functions.lenient import Lenient
from tessera.operators.infer import infer_record_types, infer_types
from tessera.operators.paging import sample_with_replacement
from tessera.session import scratch_path
from tessera.sources.bulk import log_batches, read_batches, wider_schema, write_batches
from tessera.sources.records import discover_header, header_names

CASES = [
    ("yyyy-MM-dd", "2017-02-31", "2017-03-03 00:00:00"),
    ("yyyy-MM-dd", "2016-02-30", "2016-03-01 00:00:00"),
    ("yyyy-MM-dd", "2017-13-01", "2018-01-01 00:00:00"),
    ("yyyy-MM-dd", "2017-00-00", "2016-11-30 00:00:00"),
    ("yyyy-MM-dd", "2017-1-5T12:00", "2017-01-05 00:00:00"),
    ("yyyy-MM-dd", "2017-1-400", "2018-02-04 00:00:00"),
    ("yyyy-MM-dd", "x2017-01-05", None),
    ("yyyy-MM-dd", "2017/01/05", None),
    ("yyyy-MM-dd", "2017-01", None),
    ("yyyy-MM-dd HH:mm:ss", "2017-01-05 25:00:00", "2017-01-06 01:00:00"),
    ("yyyy-MM-dd HH:mm:ss", "2017-12-31 23:59:60", "2018-01-01 00:00:00"),
    ("yyyy-MM-dd HH:mm:ss", "2017-01-05   1:61:-", None),
    ("yyyy-MM-dd HH:mm:ss", "2017-01-05 1:61:3 PM", "2017-01-05 02:01:03"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "2017-01-05T01:02:03.5Z", "2017-01-05 01:02:03.005"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "2017-01-05T01:02:03.61000Z", "2017-01-05 01:03:04"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "2017-01-05T01:02:03.5", None),
    ("yyyyMMdd", "20170231x", "2017-03-03 00:00:00"),
    ("yyyyMMddHHmm", "201702282561", "2017-03-01 02:01:00"),
    ("dd.MM.yyyy", "5.1.2017.", "2017-01-05 00:00:00"),
    ("yyyy 'o''clock' HH", "2017 o'clock 30", "2017-01-02 06:00:00"),
    ("yyyy-MM-dd", "2017-1234567-01", None),
    ("yyyy-MM-dd", "9" * 30, None),
]


def test_lenient_timestamps(spark):
    for pattern in {p for p, _, _ in CASES}:
        rows = [(t, w) for p, t, w in CASES if p == pattern]
        df = spark.createDataFrame(rows, "t string, want string")
        got = df.select("t", "want", cast_value(F.col("t"), T.TimestampNTZType(), date_format=Lenient(pattern), on_error="null").alias("ts"), cast_value(F.col("t"), T.TimestampType(), date_format=Lenient(pattern), on_error="null").cast("string").alias("tz")).collect()
        for r in got:
            want = None if r["want"] is None else dt.datetime.fromisoformat(r["want"])
            assert r["ts"] == want, (pattern, r["t"])
            assert (r["tz"] is None) == (want is None)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1000, 9000), *[st.integers(0, 5000)] * 5), min_size=1, max_size=20))
def test_lenient_arithmetic(spark, rows):
    df = spark.createDataFrame([(f"{y}-{mo}-{d} {h}:{m}:{s} etc",) for y, mo, d, h, m, s in rows], "t string")
    got = [r[0] for r in df.select(cast_value(F.col("t"), T.TimestampNTZType(), date_format=Lenient("yyyy-MM-dd HH:mm:ss"))).collect()]
    for (y, mo, d, h, m, s), v in zip(rows, got, strict=True):
        months = y * 12 + mo - 1
        assert v == dt.datetime(months // 12, months % 12 + 1, 1) + dt.timedelta(days=d - 1, hours=h, minutes=m, seconds=s)


def test_lenient_inference_and_refusals(spark):
    df = spark.createDataFrame([("2017-02-31",), ("2017-13-01 x",), ("",)], "a string")
    assert infer_types(df, date_format=Lenient("yyyy-MM-dd")).first()["type"] == "timestamp"
    assert infer_types(df, date_format="yyyy-MM-dd").first()["type"] == "string"
    for bad in ("yy-MM-dd", "yyyy-MMM-dd", "yyyy hh a", "MM-dd", "yyyy 'x", "yyyy-yyyy"):
        with pytest.raises(ValueError):
            Lenient(bad)
    with pytest.raises(Exception, match="cannot cast"):
        df.select(cast_value(F.lit("no date"), T.TimestampType(), date_format=Lenient("yyyy"))).collect()


@pytest.mark.parametrize("n", [0, 1, 400])
def test_sample_with_replacement(spark, n):
    import hashlib

    src = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_name").limit(97)
    src = spark.createDataFrame(src.collect(), src.schema)
    keys = sorted(r[0] for r in src.collect())
    want = [(i, keys[int(hashlib.md5(f"5:{i}".encode()).hexdigest()[:15], 16) % len(keys)]) for i in range(n)]
    for parts in (1, 7):
        got = sample_with_replacement(src.repartition(parts), n, ["c_custkey"], seed=5)
        assert sorted((r["draw"], r["c_custkey"]) for r in got.collect()) == want
    assert sample_with_replacement(src.where("false"), n, ["c_custkey"]).count() == 0
    with pytest.raises(ValueError):
        sample_with_replacement(src, -1, ["c_custkey"])


def test_headers_are_bounded(spark):
    recs = spark.range(300).select(F.create_map(F.concat(F.lit("id"), F.col("id").cast("string")), F.lit("1"), F.lit("n"), F.lit("2")).alias("rec"))
    assert len(header_names(recs, max_names=301)) == 301 and len(header_names(recs, mode="widest")) == 2
    for call in (lambda: header_names(recs, max_names=300), lambda: discover_header(recs, max_names=5).collect(), lambda: infer_record_types(recs, max_names=300).collect(), lambda: header_names(recs, mode="widest", max_names=1)):
        with pytest.raises(Exception, match="field names"):
            call()
    assert infer_record_types(recs, max_names=301).count() == 301


def people(spark, first, n=100):
    return spark.range(first, first + n).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("first"), "id").alias("first"), F.concat(F.lit("last"), "id").alias("last"))


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_replaced_batch_keeps_nothing_of_its_first_writing(spark):
    df, path = people(spark, 0), scratch_path(spark, "bulk-again")
    write_batches(df, path, ["i"], results_per_batch=2, split="exact")
    manifest = write_batches(df.withColumn("first", F.lit("new")), path, ["i"], columns=["last", "first", "i"], split="exact")
    back = read_batches(spark, path, manifest, schema=df.schema)
    assert back.count() == 100 and back.where("first = 'new'").count() == 100
    assert bag(read_batches(spark, path).select("i", "first", "last")) == sorted(((str(a), b, c) for a, b, c in bag(back)), key=repr)
    # Another batch beside it stays.
    manifest = write_batches(people(spark, 500, 3), path, ["i"], first_batch=9)
    assert read_batches(spark, path, manifest, schema=df.schema).count() == 103


def test_the_last_state_of_a_batch_counts(spark):
    df, path = people(spark, 0), scratch_path(spark, "bulk-last-state")
    manifest = write_batches(df, path, ["i"], split="exact")
    rows = spark.createDataFrame([{**r.asDict(), "seq": None} for r in manifest.collect()], manifest.schema)
    manifest = log_batches(rows.withColumn("state", F.lit("Failed")), path)
    assert read_batches(spark, path, manifest, schema=df.schema).count() == 0
    manifest = log_batches(rows, path)
    assert read_batches(spark, path, manifest, schema=df.schema).count() == 100
    # A new run that failed hides the old one.
    manifest = write_batches(people(spark, 0, 5), path, ["i"], split="exact")
    newest = manifest.orderBy(F.desc("seq")).first()["run"]
    manifest = log_batches(manifest.where(F.col("run") == newest).withColumn("state", F.lit("Failed")), path)
    assert read_batches(spark, path, manifest, schema=df.schema).count() == 0
    assert sorted({r["seq"] for r in manifest.collect()}) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("infer", [False, True])
def test_columns_go_by_name_without_a_schema(spark, infer):
    df = spark.createDataFrame([(1, "Bob", "Kim"), (2, "Amy", "Lee")], "i int, first string, last string")
    path = scratch_path(spark, "bulk-names")
    write_batches(df, path, ["i"])
    write_batches(df.withColumn("i", F.col("i") + 1.5), path, ["i"], columns=["last", "i", "first"], first_batch=5)
    write_batches(df.withColumn("extra", F.lit("x")), path, ["i"], columns=["extra", "first", "i"], first_batch=9)
    back = read_batches(spark, path, infer=infer)
    assert back.columns == ["i", "first", "last", "extra"] and dict(back.dtypes)["i"] == ("double" if infer else "string")
    num = float if infer else str
    want = [(num(i), f, last, None) for i, f, last in ((1, "Bob", "Kim"), (2, "Amy", "Lee"), (2.5, "Bob", "Kim"), (3.5, "Amy", "Lee"))] + [(num(1), "Bob", None, "x"), (num(2), "Amy", None, "x")]
    assert bag(back) == sorted(want, key=repr)


def test_wider_schema():
    kinds = lambda *ts: T.StructType([T.StructField("a", t) for t in ts])
    one = lambda *ts: wider_schema([kinds(t) for t in ts])["a"]
    assert one(T.IntegerType(), T.LongType()) == T.LongType() and one(T.DoubleType(), T.IntegerType()) == T.DoubleType()
    assert one(T.DateType(), T.IntegerType()) == T.StringType() and one(T.BooleanType()) == T.BooleanType()

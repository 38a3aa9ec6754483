"""Multi-line CSV by byte ranges against Spark's own multi-line reader."""

import random
import tempfile
from pathlib import Path

import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.session import scratch_path
from tessera.sources.csvranges import read_multiline, record_texts

OPTIONS = {"header": "true", "quote": '"', "escape": '"', "lineSep": "\n"}


@pytest.fixture(scope="module")
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "997")
    spark.conf.set(names[1], "1")
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def put(spark, name, text):
    path = Path(tempfile.mkdtemp(prefix="run-")) / f"{name}.csv"
    path.write_bytes(text.encode())
    return str(path)


def quoted(v):
    return "" if v is None else '"' + v.replace('"', '""') + '"'


def same_as_multiline(spark, path, schema):
    own = read_multiline(spark, path, schema)
    ref = spark.read.options(**OPTIONS, multiLine="true").schema(schema).csv(path)
    assert sorted(map(tuple, own.collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)
    return own


def test_one_file_gives_many_tasks_and_the_same_rows(spark, small_ranges):
    rng = random.Random(1)
    words = ["a", "", "\n", "line one\nline two", 'say ""', "x,y", "\r", "é\n\n\n", '"', "w" * 40]
    rows = [(k, "".join(rng.choice(words) for _ in range(rng.randrange(6))) or None, rng.choice(["p", None, "q\nr"])) for k in range(2000)]
    rows[700] = (700, "long\n" * 2000, 'ends "\n"')  # spans ten ranges
    path = put(spark, "one", "i,t,u\n" + "".join(f"{i},{quoted(t)},{quoted(u)}\n" for i, t, u in rows))
    own = same_as_multiline(spark, path, spark.createDataFrame(rows[:1], "i long, t string, u string").schema)
    assert own.count() == 2000
    records = record_texts(spark, path)
    assert records.select("range").distinct().count() > 50 and records.count() == 2001
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 50
    final = own.collect() and own._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final  # the lines are shuffled once


def test_documents_and_several_files(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "csv-docs")
    docs.repartition(3).write.options(header="true", quote='"', escape='"').csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        back = read_multiline(spark, path, docs.schema)
        assert back.exceptAll(docs).count() == 0 and back.count() == docs.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("text, n", [("a,b\n", 0), ("a,b\n1,2", 1), ("a,b\n\n1,2\n\n\n", 1), ('a,b\n"1\n\n","2"\n', 1), ("a,b\n" + "1,2\n" * 700, 700)])
def test_small_files(spark, small_ranges, text, n):
    path = put(spark, "small", text)
    schema = spark.createDataFrame([], "a string, b string").schema
    assert same_as_multiline(spark, path, schema).count() == n


def test_another_header_is_refused(spark, small_ranges):
    schema = spark.createDataFrame([], "a string, b string").schema
    with pytest.raises(Exception, match="header is not"):
        read_multiline(spark, put(spark, "bad", "b,a\n1,2\n"), schema).collect()
    assert read_multiline(spark, put(spark, "none", "1,2\n3,4\n"), schema, header=False).count() == 2


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from(list('ab",\n é')), max_size=40), st.text(st.sampled_from(list('x"\n')), max_size=400)), min_size=1, max_size=40))
def test_any_quoted_text(spark, small_ranges, rows):
    path = put(spark, "any", "a,b\n" + "".join(f"{quoted(x)},{quoted(y)}\n" for x, y in rows))
    schema = spark.createDataFrame([], "a string, b string").schema
    got = [tuple(r) for r in read_multiline(spark, path, schema, ignoreLeadingWhiteSpace="false").collect()]
    assert sorted(got, key=repr) == sorted(((x or None, y or None) for x, y in rows), key=repr)  # an empty text reads as null

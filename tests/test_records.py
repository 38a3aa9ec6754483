from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF

from tessera.operators.infer import infer_schema, infer_types, merge_types
from tessera.operators.paging import concat_pages
from tessera.plans.read import read_records
from tessera.sources.records import discover_header, header_names, to_records

REC = "rec map<string,string>"


PATTERN = "dd/MM/yyyy HH:mm"


def records(spark, maps):
    return spark.createDataFrame([(m,) for m in maps], REC)


def event_maps(spark, n=50):
    """String-map records made from events, their time in a pattern of its own."""
    ev = spark.read.parquet(f"{SF}/events.parquet").orderBy("event_id").limit(n)
    return to_records(ev.select("user_id", "event_type", F.date_format("ts", PATTERN).alias("seen")), rec="rec"), ev


def test_read_without_schema_all_strings(spark):
    df, ev = event_maps(spark)
    out = read_records(df)
    assert all(isinstance(f.dataType, T.StringType) for f in out.schema.fields)
    want = sorted((str(r["user_id"]), r["event_type"]) for r in ev.collect())
    assert sorted((r["user_id"], r["event_type"]) for r in out.collect()) == want


def test_read_with_user_schema_and_pattern(spark):
    df, ev = event_maps(spark)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("seen", T.TimestampType())])
    got = sorted(map(tuple, read_records(df, schema=schema, date_format=PATTERN).collect()))
    assert got == sorted((r["user_id"], r["ts"].replace(second=0, microsecond=0)) for r in ev.collect())


def test_inference_int_string_timestamp(spark):
    out = read_records(event_maps(spark)[0], infer=True, date_format=PATTERN)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types == {"event_type": T.StringType(), "seen": T.TimestampNTZType(), "user_id": T.IntegerType()}
    assert all(f.nullable for f in out.schema.fields)


def test_pages_concatenate(spark):
    first, _ = event_maps(spark, 30)
    second, _ = event_maps(spark, 7)
    assert read_records(concat_pages([first, second])).count() == 37


def test_ragged_headers(spark):
    df = records(spark, [{"a": "1", "b": "x"}, {"a": "2", "c": "y"}, {}, {"d": None}])
    assert header_names(df, mode="union") == ["a", "b", "c", "d"]
    assert header_names(df, mode="widest") == ["a", "c"]


def test_missing_field_reads_blank_explicit_null_stays_null(spark):
    df = records(spark, [{"a": "1", "s": "x"}, {"a": None}])
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("s", T.StringType())])
    rows = read_records(df, schema=schema).collect()
    assert (rows[0]["a"], rows[0]["s"]) == (1, "x")
    assert (rows[1]["a"], rows[1]["s"]) == (None, "")


def test_empty_records_give_empty_schema(spark):
    df = spark.createDataFrame([], REC)
    assert read_records(df).schema == T.StructType([])


def test_inference_is_partition_independent(spark):
    vals = [("1",), ("", ), ("2147483648",), (None,), ("3",)] * 7
    base = spark.createDataFrame(vals, "v string")
    answers = set()
    for n in (1, 4, 13):
        answers.add(tuple(infer_schema(base.repartition(n)).fields))
    assert len(answers) == 1
    assert infer_schema(base).fields[0].dataType == T.LongType()


def test_inference_candidates(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2021-11-30 08:15:00", "true", "", "1", "x")] * 3
        + [("2", "7", "2021-3-9 7:1:2", "FALSE", None, "2021-11-30 08:15:00", "y")],
        "i string, d string, ts string, b string, e string, mixed string, s string",
    )
    got = {r["column"]: r["type"] for r in infer_types(df).collect()}
    assert got == {"i": "integer", "d": "double", "ts": "timestamp", "b": "boolean", "e": "string",
                   "mixed": "string", "s": "string"}


def test_merge_types_precedence(spark):
    pairs = [("a", "integer"), ("a", "long"), ("b", "integer"), ("b", "timestamp"), ("c", "integer"),
             ("c", "boolean"), ("d", None), ("d", "double"), ("e", None), ("f", "string"), ("f", "string")]
    df = spark.createDataFrame(pairs, "column string, type string")
    got = {r["column"]: r["type"] for r in merge_types(df).collect()}
    assert got == {"a": "long", "b": "timestamp", "c": "string", "d": "double", "e": "string", "f": "string"}


def test_header_discovery_distributed(spark):
    df = records(spark, [{"k%d" % (i % 5): "v"} for i in range(50)]).repartition(7)
    assert [r["name"] for r in discover_header(df).orderBy("position").collect()] == ["k0", "k1", "k2", "k3", "k4"]


def test_widest_read_matches_header(spark):
    df = records(spark, [{"a": "1", "b": "x"}, {"a": "2", "c": "2021-11-30 08:15:00"}, {}, {"c": "2021-3-9 7:1:2"}])
    out = read_records(df, infer=True, header_mode="widest")
    assert out.columns == header_names(df, mode="widest") == ["a", "c"]
    assert {f.name: f.dataType for f in out.schema.fields} == {"a": T.IntegerType(), "c": T.TimestampNTZType()}

from conftest import SF

from tessera.functions.encode import csv_header, csv_lines
from tessera.operators.parts import encoded_size


def test_csv_value_rule(spark):
    vals = ['a"b', "x,y", "l\nm", "r\rs", "", None, " p ", "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = {r["i"]: r["line"] for r in csv_lines(df, ["v"], keep=["i"]).collect()}
    assert [got[i] for i in range(len(vals))] == ['"a""b"', '"x,y"', '"l\nm"', "r\rs", "", "", " p ", "plain"]


def test_double_text_like_jvm(spark):
    df = spark.createDataFrame([(1.0e10, 100.0, 1.0e-4)], "a double, b double, c double")
    assert csv_lines(df).first()["line"] == "1.0E10,100.0,1.0E-4"


def test_java_timestamp_style(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 179500))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert csv_lines(df, timestamp_style="java").first()["line"] == "2020-01-01 00:00:00.0,2020-01-01 00:00:00.1795"


def test_header_of_schema(spark):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    assert csv_header(nation.schema.names) == ",".join(nation.columns)
    assert csv_header(["plain", "with,comma", 'with"quote']) == 'plain,"with,comma","with""quote"'


def test_encoded_size_counts_utf8_and_newlines(spark):
    df = spark.createDataFrame([("é",), ("a,b",)], "v string")
    row = encoded_size(df).first()
    assert row["rows"] == 2 and row["bytes"] == (2 + 1) + (5 + 1)

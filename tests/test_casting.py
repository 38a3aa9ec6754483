import math
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.casting import cast_value

EDGE = ["5", "+5", " 5 ", "1d", "0x1p3", "NaN", "1e3", "2147483648", "9223372036854775808", "true", "TRUE",
        "t", "yes", "2021", "2021-11-30 08:15:09", "2021-3-9 7:1:2", "2021-11-30T08:15:09", "", None, "1,234.5",
        "nan", "inf", "Infinity", "-Infinity", "2021-11-30"]


def cast_all(spark, dtype, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(EDGE)], "i int, v string")
    rows = df.select("i", cast_value(F.col("v"), dtype, on_error="null", **kw).alias("x")).collect()
    return {EDGE[r["i"]]: r["x"] for r in rows}


def test_int(spark):
    got = cast_all(spark, T.IntegerType())
    assert got["5"] == 5 and got["+5"] == 5
    for bad in [" 5 ", "1d", "1e3", "2147483648", "true", "2021-11-30"]:
        assert got[bad] is None, bad
    assert got["2021"] == 2021
    assert got[""] is None and got[None] is None


def test_long(spark):
    got = cast_all(spark, T.LongType())
    assert got["2147483648"] == 2147483648
    assert got["9223372036854775808"] is None


def test_double_follows_jvm_spellings(spark):
    got = cast_all(spark, T.DoubleType())
    assert got[" 5 "] == 5.0 and got["1d"] == 1.0 and got["0x1p3"] == 8.0 and got["1e3"] == 1000.0
    assert math.isnan(got["NaN"]) and got["Infinity"] == math.inf and got["-Infinity"] == -math.inf
    assert got["nan"] is None and got["inf"] is None
    assert got["1,234.5"] is None


def test_boolean_only_true_false(spark):
    got = cast_all(spark, T.BooleanType())
    assert got["true"] is True and got["TRUE"] is True
    assert got["t"] is None and got["yes"] is None and got["5"] is None


def test_timestamp_value_of_rules(spark):
    got = cast_all(spark, T.TimestampNTZType())
    assert got["2021-11-30 08:15:09"] == dt.datetime(2021, 11, 30, 8, 15, 9)
    assert got["2021-3-9 7:1:2"] == dt.datetime(2021, 3, 9, 7, 1, 2)
    assert got["2021"] is None and got["2021-11-30T08:15:09"] is None and got["2021-11-30"] is None


def test_timestamp_with_pattern(spark):
    got = cast_all(spark, T.TimestampNTZType(), date_format="yyyy-MM-dd'T'HH:mm:ss")
    assert got["2021-11-30T08:15:09"] == dt.datetime(2021, 11, 30, 8, 15, 9)
    assert got["2021-11-30 08:15:09"] is None


def test_date(spark):
    got = cast_all(spark, T.DateType())
    assert got["2021-11-30"] == dt.date(2021, 11, 30)
    assert got["2021-11-30 08:15:09"] is None and got["2021"] is None


def test_decimal_drops_thousands_commas(spark):
    got = cast_all(spark, T.DecimalType(10, 1))
    assert got["1,234.5"] == Decimal("1234.5") and got["1e3"] == Decimal("1000.0")
    assert got["t"] is None


def test_blank_is_null_except_strings(spark):
    df = spark.createDataFrame([("",)], "v string")
    row = df.select(
        cast_value(F.col("v"), T.IntegerType()).alias("i"),
        cast_value(F.col("v"), T.StringType()).alias("s"),
    ).first()
    assert row["i"] is None and row["s"] == ""


def test_not_nullable_blank_raises(spark):
    df = spark.createDataFrame([("",)], "v string")
    with pytest.raises(Exception):
        df.select(cast_value(F.col("v"), T.IntegerType(), nullable=False)).collect()


def test_bad_value_raises_by_default(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception, match="cannot cast"):
        df.select(cast_value(F.col("v"), T.IntegerType(), name="v")).collect()


def test_unsupported_type_refused(spark):
    with pytest.raises(TypeError, match="Unsupported data type"):
        cast_value(F.col("v"), T.ArrayType(T.FloatType()))


def test_url_encode_string_fields(spark):
    df = spark.createDataFrame([("a b&c=é~*",)], "v string")
    assert df.select(cast_value(F.col("v"), T.StringType(), encode=True)).first()[0] == "a+b%26c%3D%C3%A9%7E*"


def test_decimal_overflow_is_an_error(spark):
    df = spark.createDataFrame([("12345678901.5",), ("1e400",), ("1.239",)], "v string")
    kind = T.DecimalType(5, 2)
    got = {r["v"]: r["x"] for r in df.select("v", cast_value("v", kind, on_error="null").alias("x")).collect()}
    assert got == {"12345678901.5": None, "1e400": None, "1.239": Decimal("1.24")}
    for bad in ("12345678901.5", "1e400"):
        with pytest.raises(Exception, match="cannot cast"):
            df.where(f"v = '{bad}'").select(cast_value("v", kind).alias("x")).collect()
